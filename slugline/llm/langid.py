"""Language identification: averaged hashed subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
ORDERS = (2, 3, 4)
DIMENSIONS = 16
BYTES_AT_ONCE = 1 << 20
MAX_LANGUAGES = 1000
# Rows of all languages together that training takes to the driver, a profile of at most 256 kB each.
SAMPLE_ROWS = 8192
UNKNOWN = "und"
def has_letter(text: str | None) -> bool:
    """Whether a text has an alphabetic character; digits of any script, fractions and signs are none."""
    return any(map(str.isalpha, text or ""))


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose text has a letter."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [has_letter(text.as_py()) for text in batch.column(1)]
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))

    rows = docs.select(F.struct("*").alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(per_batch, f"row {kind}").select("row.*")


def subword_buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the byte n-grams of every word with its borders, piece by piece."""
    data = b" " + b" ".join(text.lower().encode("utf-8", "replace").split()) + b" "
    overlap = max(ORDERS) - 1
    for start in range(0, len(data), BYTES_AT_ONCE):
        stop = min(len(data), start + BYTES_AT_ONCE)
        codes = np.frombuffer(data[start : stop + overlap], np.uint8).astype(np.uint32)
        gram = codes.copy()
        for order in range(2, max(ORDERS) + 1):
            gram = gram[: len(codes) - order + 1] << np.uint32(8) | codes[order - 1 :]
            if order not in ORDERS or not len(gram):
                continue
            size = min(len(gram), stop - start)
            keep = np.ones(size, bool)
            for inside in range(1, order - 1):
                keep &= codes[inside : inside + size] != 32
            mixed = (gram[:size][keep] ^ np.uint32(order * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            yield mixed >> np.uint32(32 - BUCKET_BITS)


def profile(text: str) -> np.ndarray:
    """Share of each bucket among a text's subwords."""
    counts = np.zeros(BUCKETS)
    for buckets in subword_buckets(text):
        counts += np.bincount(buckets, minlength=BUCKETS)
    return counts / max(counts.sum(), 1)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    table: np.ndarray  # logit of each language for each bucket
    bias: np.ndarray
    temperature: float
    least: float  # predictions with a lower calibrated score are rejected

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated score, rejected); a text without letters is `und`, rejected."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        logits, seen = np.zeros(len(self.languages)), 0
        for buckets in subword_buckets(text):
            logits += np.bincount(buckets, minlength=BUCKETS) @ self.table if len(buckets) > BUCKETS else self.table[
                buckets
            ].sum(axis=0)
            seen += len(buckets)
        odds = softmax((logits / max(seen, 1) + self.bias) / self.temperature)
        best = int(odds.argmax())
        return self.languages[best], float(odds[best]), bool(odds[best] < self.least)


def softmax(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return odds / odds.sum(axis=-1, keepdims=True)


def training_sample(docs: DataFrame, per_language: int) -> list:
    """About `per_language` labelled rows of each language, chosen by hash, as sparse profiles.

    The only bounded part of the operator: at most `MAX_LANGUAGES` labels and about `SAMPLE_ROWS`
    rows in all, of profiles of bounded size, so the driver's share depends on neither the table nor the length of a text.
    """
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    counts = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    steps = 1 << 40
    per_language = min(per_language, SAMPLE_ROWS // max(1, len(counts)))
    shares = {row["lang"]: min(steps, int(steps * per_language / row["count"]) + 1) for row in counts}
    if not shares:
        return []
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("lang")]
    key = F.pmod(F.xxhash64("doc_id", "text"), F.lit(steps))
    chosen = labelled.where(key < share).select("lang", "text", key.alias("key"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text, order in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if has_letter(text):
                    shares_of = profile(text)
                    ids = np.flatnonzero(shares_of)
                    rows.append((lang, order, ids.astype("<i4").tobytes(), shares_of[ids].astype("<f4").tobytes()))
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            types = [pa.string(), pa.int64(), pa.binary(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "key", "ids", "shares"])

    rows = chosen.mapInArrow(per_batch, "lang string, key long, ids binary, shares binary").collect()
    return sorted(rows, key=lambda row: (row["key"], row["lang"], bytes(row["ids"])))


def train(sample: list, epochs: int = 12, rate: float = 40.0, rejected: float = 0.001, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on the sample, then calibration on a fifth of it held back.

    The temperature minimises the held-back log loss. `least` is the score below which a share
    `rejected` of the held-back rows that are predicted right fall, at most a half.
    """
    languages = tuple(sorted({row["lang"] for row in sample}))
    label = {name: k for k, name in enumerate(languages)}
    rows = [(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["shares"], "<f4"), label[r["lang"]]) for r in sample]
    held, fit = rows[::5], [row for k, row in enumerate(rows) if k % 5] or rows
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / np.sqrt(DIMENSIONS), (BUCKETS, DIMENSIONS))
    weight, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in rng.permutation(len(fit)):
            ids, shares, want = fit[k]
            hidden = shares @ embed[ids]
            error = softmax(hidden @ weight + bias)
            error[want] -= 1
            back = weight @ error
            weight -= 0.01 * step * np.outer(hidden, error)
            bias -= 0.0001 * step * error
            embed[ids] -= step * np.outer(shares, back)
    table = embed @ weight
    if not rows:
        return LanguageModel((), table, bias, 1.0, 0.0)
    logits = np.array([shares @ table[ids] + bias for ids, shares, _ in held])
    truth = np.array([want for _, _, want in held])

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(softmax(logits / temperature)[np.arange(len(truth)), truth], 1e-12)).mean()

    temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    odds = softmax(logits / temperature)
    right = odds.max(axis=1)[odds.argmax(axis=1) == truth]
    least = min(0.5, float(np.quantile(right, rejected))) if len(right) else 0.0
    return LanguageModel(languages, table, bias, float(temperature), least)


def fit_languages(docs: DataFrame, per_language: int = 1000) -> LanguageModel:
    """A model from the labelled rows of `docs` (doc_id, text, lang); see `training_sample`."""
    return train(training_sample(docs, per_language))


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of `docs` in a struct `row`, with lang_pred, score and rejected.

    Whole texts are read. Null and empty texts and texts without a letter give `und`, score 0,
    rejected. Every row gives one row, repeated ones too; an empty table gives an empty one.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")
    kind = rows.schema["row"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [model.predict(text.as_py()) for text in batch.column(1)]
            names, scores, rejected = zip(*told, strict=True) if told else ((), (), ())
            arrays = [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["row", "lang_pred", "score", "rejected"])

    return rows.mapInArrow(per_batch, f"row {kind}, lang_pred string, score double, rejected boolean")
