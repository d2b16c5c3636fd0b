"""Language identification: held-out accuracy and texts without a language."""

from pyspark.sql import functions as F

import numpy as np

import corpus_pipeline
from slugline.llm import langid


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit_languages(docs.where("doc_id % 2 = 0"))
    told = langid.predict_languages(docs.where("doc_id % 2 = 1"), model)
    right = told.agg(F.avg((F.col("row.lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).head()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1
    assert told.where("rejected").count() <= 2


def test_odd_texts(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit_languages(docs)
    rows = [(1, None), (2, ""), (3, "12 -- 34\n"), (5, "½ ² ① ٣ _"), (6, "½ª"), (4, "the the " * 200_000), (4, "a"), (None, "日本語"), (7, "퟿ é")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("mine"))
    told = {(r.row.doc_id, r.row.text): r for r in langid.predict_languages(odd, model).collect()}
    assert len(told) == len(rows)
    for key in ((1, None), (2, ""), (3, "12 -- 34\n"), (5, "½ ² ① ٣ _")):
        assert (told[key].lang_pred, told[key].score, told[key].rejected) == ("und", 0.0, True)
    assert told[(4, "the the " * 200_000)].lang_pred in model.languages
    assert told[(None, "日本語")].lang_pred in model.languages and told[(4, "a")].row.score == "mine"
    assert langid.predict_languages(odd.limit(0), model).count() == 0


def test_pieces_of_a_long_text_have_the_same_subwords(monkeypatch):
    text = "Straße und Wörter " * 400
    whole = langid.profile(text)
    monkeypatch.setattr(langid, "BYTES_AT_ONCE", 101)
    assert abs(whole - langid.profile(text)).max() < 1e-12


def test_predictions_against_a_plain_model(spark, small):
    """The model's parameters applied with dictionaries, gram by gram."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = langid.fit_languages(docs)
    rows = [(k, r.text) for k, r in enumerate(docs.select("text").limit(25).collect())] + [(90, "Ça va? ÀÉ 12 x"), (91, "a")]
    told = langid.predict_languages(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    for row in told:
        data = b" " + b" ".join(row.row.text.lower().encode().split()) + b" "
        logits, seen = [0.0] * len(model.languages), 0
        for order in langid.ORDERS:
            for k in range(len(data) - order + 1):
                gram = data[k : k + order]
                if b" " in gram[1:-1]:
                    continue
                bucket = ((int.from_bytes(gram, "big") ^ (order * 0x3C6EF372 % 2**32)) * 0x9E3779B1 % 2**32) >> (32 - langid.BUCKET_BITS)
                logits = [x + w for x, w in zip(logits, model.table[bucket], strict=True)]
                seen += 1
        odds = np.exp([(x / max(seen, 1) + b) / model.temperature for x, b in zip(logits, model.bias, strict=True)])
        odds /= odds.sum()
        assert row.lang_pred == model.languages[int(odds.argmax())] and abs(row.score - odds.max()) < 1e-9
        assert row.rejected == (odds.max() < model.least)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.fit_languages(docs)
    assert [r.lang_pred for r in langid.predict_languages(docs, model).collect()] == ["und", "und"]


def test_stage_keeps_texts_with_letters_when_no_row_has_a_label(spark):
    rows = [(1, "clean text", None), (2, "日本語", None), (3, "12 _ 34", "en"), (4, "", None), (5, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("row", F.lit(1))
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
