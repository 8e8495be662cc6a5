import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import langid
from paperloom.llm.tables import table

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_rejection(spark):
    docs = table(spark, SF, "documents")
    rows = langid.scan_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    sure = [r for r in held if r.accepted]
    assert sum(r.lang == r.lang_pred for r in sure) / len(sure) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_languages_and_other_columns_do_not_matter(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    other = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    first = {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in langid.scan_documents(docs).collect()}
    assert first == {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in langid.scan_documents(other).collect()}


def test_tables(spark, docs_of, edge_rows):
    known = table(spark, SF, "documents").limit(300).collect()
    rows = [*((None if i is None else i + 10_000, t) for i, t in edge_rows), *((r.doc_id, r.text) for r in known), (20_000, "123 ... ²³"), (20_001, "é")]
    lang = {r.doc_id: r.lang for r in known}
    docs = docs_of(rows).drop("lang").join(spark.createDataFrame(list(lang.items()), "doc_id long,lang string"), "doc_id", "left")
    got = langid.scan_documents(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i in (10_001, 10_002, 10_003, 20_000):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[20_001].lang_pred in set(lang.values())


def test_without_training_rows(docs_of):
    assert [(r.lang_pred, r.score) for r in langid.scan_documents(docs_of([(1, "a text"), (2, None)])).collect()] == [("und", 0.0)] * 2
    assert langid.scan_documents(docs_of([])).collect() == []


def test_long_texts_are_counted_in_whole(monkeypatch):
    text = "Some longer text, é漢 and more " * 50
    whole = langid.bucket_counts(text)
    monkeypatch.setattr(langid, "HASHED_AT_ONCE", 37)
    assert (langid.bucket_counts(text) == whole).all()


def test_predictions_equal_the_definition():
    """Subwords one by one: their buckets, the average of their rows, and the softmax of the sums."""
    rng = np.random.default_rng(3)
    model = langid.Model(["a", "b", "c"], rng.standard_normal((langid.BUCKETS, 3)), rng.standard_normal(3), 1.5, 0.5)
    for text in ("Das ist ein Satz.", "Une phrase, déjà vu 12!", "x", "漢字 かな", "A\tb\n c", "word " * 200):
        letters = "".join(c if ord(c) >= 0x80 or "a" <= c <= "z" else " " for c in text.lower())
        raw = b" " + " ".join(letters.split(" ")).encode() + b" "
        while b"  " in raw:
            raw = raw.replace(b"  ", b" ")
        places = []
        for size in (2, 3, 4):
            for i in range(len(raw) - size + 1):
                value = int.from_bytes(raw[i : i + size], "big") ^ size
                places.append((value * 2654435761 % 2**32) >> (32 - langid.BUCKET_BITS))
        assert np.array_equal(langid.bucket_counts(text), np.bincount(places, minlength=langid.BUCKETS))
        z = (model.table[places].mean(0) + model.bias) / model.temperature
        p = np.exp(z) / np.exp(z).sum()
        lang, score, accepted = model.predict(text)
        assert lang == "abc"[p.argmax()] and score == pytest.approx(p.max()) and accepted == (p.max() >= 0.5)
