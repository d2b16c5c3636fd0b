"""Personal data: fixed forms, and identifiers found by bootstrapped lexical patterns."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from slugline.llm.common import written

KINDS = ("email", "ip", "card", "phone")
# Patterns that one broadcast may hold; more are counted in several passes over the texts.
PATTERNS_AT_ONCE = 500_000

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot start inside a run of digits, so possessive runs find the same in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", re.A)
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++", re.A)
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]", re.A)
_DIGIT = re.compile(r"[0-9]", re.A)


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(number: str) -> bool:
    total = sum(map(int, number[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in number[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each `@`: all of the local part since the last match, then the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed forms, by kind and then start."""
    spans = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        number = digits(m[0]) if m.end() - m.start() >= 13 else ""
        if 13 <= len(number) <= 19 and passes_luhn(number):
            spans.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


# --- candidates and their contexts -------------------------------------------------------------

_MARK = re.compile(r"[0-9@]|[\[(]at[\])]", re.A | re.I)
_AT = frozenset(("@", "[at]", "(at)"))
_EDGE = " \t\r\n\v\f.,;:!?\"'()[]{}<>#$%&*|"
# Shapes, looser than the fixed forms, that an identifier of a kind may have.
_SHAPES = (
    ("email", re.compile(r"[\w.%+-]+(?:@|\[at\]|\(at\))[\w.-]*\w", re.I)),
    ("card", re.compile(r"[0-9]{4}(?:[./_-]?[0-9]{4}){2}(?:[./_-]?[0-9]{1,7})")),
    ("ip", re.compile(r"[0-9a-f]{0,4}(?:[.:][0-9a-f]{0,4}){3,7}", re.I)),
    ("phone", re.compile(r"\(?0?[0-9]{2,5}\)?(?:[./-]?[0-9]{2,5}){1,4}")),
)
# Shapes of digit groups that blanks, brackets, dots and dashes join.
_GAP = r"[\x20\t./_-]{0,3}"
_SPREAD = (
    ("card", re.compile(rf"[0-9]{{4}}{_GAP}(?:[0-9]{{4}}{_GAP}){{2}}[0-9]{{1,7}}|[0-9]{{4}}{_GAP}[0-9]{{6}}{_GAP}[0-9]{{5}}")),
    ("phone", re.compile(rf"\+?\(?[0-9]{{1,5}}\)?(?:{_GAP}\(?[0-9]{{2,5}}\)?){{1,6}}")),
)
_GROUPS = re.compile(r"\+?\(?[0-9][0-9()./_-]*|[./-]", re.A)
# A word ends at white space and behind `:`, `=` and `#`, so that `tel:` announces what is glued to it;
# groups of hexadecimal digits between colons stay together.
_WORD = re.compile(r"(?:[0-9a-f]{0,4}:){2,}+[0-9a-f:.]*+|[^\x20\x09-\x0D:=#]++[:=#]*+|[:=#]++", re.I)
# Longer words stand for themselves by a digest in patterns.
LONG_WORD = 96
# A round of learning that moves no score by more than this is the last.
STILL = 1e-6


def words_of(text: str) -> tuple[list[int], list[int]]:
    """Starts and ends of the words of a text."""
    bounds = [m.span() for m in _WORD.finditer(text)]
    return [a for a, _ in bounds], [b for _, b in bounds]


def shape_of(token: str) -> str | None:
    for kind, shape in _SHAPES:
        if shape.fullmatch(token) and (kind == "email" or len(digits(token)) >= 7 or kind == "ip"):
            return kind
    return None


def spread_shape_of(span: str) -> str | None:
    number = digits(span)
    if not 7 <= len(number) <= 19:
        return None
    for kind, shape in _SPREAD:
        if (kind == "card" or len(number) <= 15) and shape.fullmatch(span):
            return kind
    return None


def candidate_spans(text: str, base: list[Span], words: tuple[list[int], list[int]] | None = None) -> list[Span]:
    """What has a kind's shape and no base span touches: words, and digit groups or `[at]` among blanks.

    Of the spans that start with a word the longest counts, so all digit groups of a number
    belong to it; the next one starts behind it.
    """
    if not base and not _MARK.search(text):
        return []
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = words or words_of(text)
    found, k, i = [], 0, 0

    def core(j: int) -> tuple[int, int]:
        word = text[starts[j] : ends[j]].rstrip(_EDGE)
        end = starts[j] + len(word)
        start = end - len(word.lstrip(_EDGE))
        if start > starts[j] and text[start - 1] == "(":
            start -= 1
        return start, end

    def joined_to(j: int) -> bool:
        """Whether only blanks stand between the words j and j + 1."""
        return j + 1 < len(starts) and not text[ends[j] : starts[j + 1]].strip(" \t")

    def longest(start: int, limit: int) -> tuple[str, int, int, int] | None:
        """(kind, end, next word): the longest run of digit groups from word i that has a shape."""
        best, j, number = None, i, 0
        while True:
            a, b = (start, ends[j]) if j == i else (starts[j], ends[j])
            end = a + len(text[a:b].rstrip(_EDGE.replace(")", "")))
            if end - a > 40 or end > limit or not _GROUPS.fullmatch(text, a, end):
                # The last group may have a bracket that closes what stands around the number.
                return best
            number += len(digits(text[a:end]))
            if number > 19:
                return best
            last = end
            if text.count("(", start, end) < text.count(")", start, end):
                last = start + len(text[start:end].rstrip(")"))
            if j > i and (kind := spread_shape_of(text[start:last])):
                around = text[start] == "(" and text[last - 1] == ")" and text.count("(", start, last) == 1
                best = kind, start + around, last - around, j + 1
            if end < b or last < end or not joined_to(j):
                return best
            j += 1

    while i < len(starts):
        start, end = core(i) if _MARK.search(text, starts[i], ends[i]) else (0, 0)
        spaced = joined_to(i) and text[starts[i + 1] : ends[i + 1]].lower() in _AT and joined_to(i + 1)
        if start >= end and not spaced:
            i += 1
            continue
        if start >= end:
            start, end = core(i)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        limit = taken[k][0] if k < len(taken) else len(text)
        best = None
        if spaced and start < end and (stop := core(i + 2)[1]) <= limit:
            whole = text[start:end] + text[starts[i + 1] : ends[i + 1]] + text[starts[i + 2] : stop]
            if shape_of(whole) == "email":
                best = "email", start, stop, i + 3
        best = best or longest(start, limit)
        if best is None and start < end <= limit:
            if text[start] == "(" and ")" not in text[start:end]:
                start += 1
            if kind := shape_of(text[start:end]):
                best = kind, start, end, i + 1
        if best:
            found.append(best[:3])
        i = best[3] if best else i + 1
    return found


def _shortened(word: str) -> str:
    return word if len(word) <= LONG_WORD else hashlib.md5(word.encode("utf-8", "replace")).hexdigest()


def normal_word(word: str) -> str:
    """A word as patterns have it: case folded, which no neighbour of a letter influences, and digits alike."""
    return _shortened(_DIGIT.sub("0", word.casefold()))


def normal_words(text: str) -> list[str]:
    return [_shortened(word) for word in _WORD.findall(_DIGIT.sub("0", text.casefold()))]


def patterns_before(text: str, start: int, words: tuple[list[int], list[int]] | None = None) -> tuple[str, ...]:
    """Lexical patterns of a place: the two whole words before the word it is in, and the one; their score judges both."""
    starts, ends = words or words_of(text)
    k = bisect_right(starts, start) - 1
    near = [normal_word(text[starts[j] : ends[j]]) for j in range(max(0, k - 2), k)]
    pair = (" ".join(near),) if len(near) == 2 else ()
    return pair + tuple(near[-1:])


def occurrences(docs: DataFrame) -> DataFrame:
    """(kind, value, pattern, seed, n): identifiers and candidates in their contexts, counted by task."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            rows = [(*key, n) for key, n in held.items()]
            held.clear()
            types = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "value", "pattern", "seed", "n"])

        for batch in batches:
            for scalar in batch.column(0):
                text = scalar.as_py() or ""
                base = base_spans(text)
                if not base and not _MARK.search(text):
                    continue
                words = words_of(text)
                for spans, seed in ((base, True), (candidate_spans(text, base, words), False)):
                    for kind, a, b in spans:
                        value = hashlib.md5(text[a:b].lower().encode("utf-8", "replace")).hexdigest()
                        for pattern in patterns_before(text, a, words):
                            held[kind, value, pattern, seed] += 1
                if len(held) > 1 << 16:
                    yield out()
        yield out()

    schema = "kind string, value string, pattern string, seed boolean, n long"
    return docs.select("text").mapInArrow(per_partition, schema).groupBy("kind", "value", "pattern").agg(
        F.max("seed").alias("seed"), F.sum("n").alias("n")
    )


def pattern_totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern occurs in the texts, whatever follows."""
    spark = docs.sparkSession
    parts = max(1, -(-patterns.count() // PATTERNS_AT_ONCE))
    totals = None
    for k in range(parts):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == k)
        names = [row["pattern"] for row in mine.collect()]
        if not names:
            continue
        wanted = spark.sparkContext.broadcast((frozenset(names), frozenset(n.rpartition(" ")[2] for n in names)))

        def per_partition(batches: Iterator[pa.RecordBatch], wanted: Broadcast = wanted) -> Iterator[pa.RecordBatch]:
            whole, lasts = wanted.value
            held: Counter = Counter()
            for batch in batches:
                for scalar in batch.column(0):
                    words = normal_words(scalar.as_py() or "")
                    for i, word in enumerate(words):
                        if word in lasts:
                            if word in whole:
                                held[word] += 1
                            if i and (pair := f"{words[i - 1]} {word}") in whole:
                                held[pair] += 1
            arrays = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["pattern", "total"])

        counted = docs.select("text").mapInArrow(per_partition, "pattern string, total long")
        totals = counted if totals is None else totals.unionByName(counted)
    if totals is None:
        return spark.createDataFrame([], "pattern string, total long")
    return totals.groupBy("pattern").agg(F.sum("total").alias("total"))


def learn_patterns(
    docs: DataFrame, least_values: int = 3, least_score: float = 0.5, smoothing: float = 1.0
) -> DataFrame:
    """(kind, pattern, score): lexical patterns that announce identifiers of a kind.

    Seeds are the fixed forms. In each round a pattern's score is the confidence of what it
    announces over all its occurrences in the corpus (plus `smoothing`), so a pattern that
    ordinary words follow scores low; patterns with `least_values` different confident values
    and `least_score` are taken. A candidate's confidence is the chance that not all patterns
    taken that announce it are wrong; candidates then support further patterns. Scores only
    rise from round to round; rounds end when no pattern is new and no score rises by more than
    `STILL`. All of it runs on the table of occurrences, aggregated by task.
    """
    spark = docs.sparkSession
    edges = written(occurrences(docs), "occurrences")
    support = edges.groupBy("kind", "pattern").agg(F.count("*").alias("values")).where(F.col("values") >= least_values)
    totals = written(pattern_totals(docs, support.select("pattern").distinct()), "totals")
    graph = written(edges.join(support.drop("values"), ["kind", "pattern"]).join(totals, "pattern"), "graph")
    belief = graph.where("seed").select("kind", "value").distinct().withColumn("belief", F.lit(1.0))
    taken = spark.createDataFrame([], "kind string, pattern string, score double")
    while True:
        judged = graph.join(belief, ["kind", "value"], "left").groupBy("kind", "pattern").agg(
            (F.sum(F.col("n") * F.coalesce("belief", F.lit(0.0))) / (F.first("total") + smoothing)).alias("score"),
            F.count_if(F.col("belief") >= least_score).alias("values"),
        )
        good = judged.where((F.col("score") >= least_score) & (F.col("values") >= least_values))
        before = taken.withColumnRenamed("score", "before")
        taken = written(good.select("kind", "pattern", F.least("score", F.lit(1.0)).alias("score")), "patterns")
        moved = taken.join(before, ["kind", "pattern"], "left").where(F.col("score") - F.coalesce("before", F.lit(-1.0)) > STILL)
        if moved.isEmpty():
            break
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        found = graph.where("NOT seed").join(taken, ["kind", "pattern"]).groupBy("kind", "value").agg(
            (1 - doubt).alias("belief")
        )
        seeds = graph.where("seed").select("kind", "value").distinct().withColumn("belief", F.lit(1.0))
        belief = written(seeds.unionByName(found).groupBy("kind", "value").agg(F.max("belief").alias("belief")), "belief")
    return taken


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in dict.fromkeys(ordered(spans)))


def parsed(spans: str) -> list[Span]:
    return [(kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in spans.split(",") if s)]


def find_personal_data(docs: DataFrame, patterns: DataFrame | None = None) -> DataFrame:
    """(doc_id, base, more): spans "kind:start:end" of every whole text, joined by commas.

    `base` are the fixed forms, `more` the identifiers that learnt patterns announce and that no
    base span touches. Code points, end exclusive. Null and empty texts have none; every row
    gives a row, repeated ones too; an empty table gives an empty one. Patterns are broadcast up
    to `PATTERNS_AT_ONCE`; beyond that the texts are read once for each part of them.
    """
    spark = docs.sparkSession
    found = (patterns if patterns is not None else learn_patterns(docs)).select("kind", "pattern")
    parts = max(1, -(-found.count() // PATTERNS_AT_ONCE))
    key = docs.schema["doc_id"].dataType.simpleString()
    told = docs.select("doc_id", "text", F.lit(None).cast("string").alias("base"), F.lit("").alias("more"))
    for k in range(parts):
        rows = found.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == k).collect()
        known = spark.sparkContext.broadcast(frozenset((r["kind"], r["pattern"]) for r in rows))
        last = k == parts - 1

        def per_batch(batches: Iterator[pa.RecordBatch], known=known, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                base, more = [], []
                for scalar, before in zip(batch.column(1), batch.column(3).to_pylist(), strict=True):
                    text = scalar.as_py() or ""
                    spans = base_spans(text)
                    words = words_of(text) if known.value and _MARK.search(text) else ([], [])
                    new = [
                        (kind, a, b)
                        for kind, a, b in (candidate_spans(text, spans, words) if words[0] else [])
                        if any((kind, p) in known.value for p in patterns_before(text, a, words))
                    ]
                    base.append(joined(spans))
                    more.append(joined([*new, *parsed(before)]))
                arrays = [batch.column(0), pa.array(base, pa.string()), pa.array(more, pa.string())]
                names = ["doc_id", "base", "more"]
                if not last:
                    arrays, names = [*arrays, batch.column(1)], [*names, "text"]
                yield pa.RecordBatch.from_arrays(arrays, names)

        schema = f"doc_id {key}, base string, more string" + ("" if last else ", text string")
        told = told.select("doc_id", "text", "base", "more").mapInArrow(per_batch, schema)
        told = told if last else written(told, "told")
    return told
