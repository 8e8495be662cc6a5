import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import quality
from paperloom.llm.tables import table

SF = "/root/testdata/sf0.001"


def test_held_out_fold(spark):
    rows = spark.range(200).select("id", quality.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_held_out_accuracy(spark):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    scored = quality.score_documents(table(spark, "/root/testdata/sf0.01", "documents"), labels)
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted", "score").collect()
    assert len(rows) > 80 and sum(r.quality == r.predicted for r in rows) / len(rows) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_other_columns_and_labels_of_the_fold_do_not_matter(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    changed = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.score_documents(docs, labels).collect()
    b = quality.score_documents(docs.withColumn("lang", F.lit("zz")), changed.withColumn("x", F.lit(1))).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in a} == {(r.doc_id, round(r.score, 9)) for r in b}


def test_tables(spark, docs_of, edge_rows):
    labels = table(spark, SF, "labels")
    documents = table(spark, SF, "documents").select("doc_id", "text").collect()
    rows = [(r.doc_id + 1000, r.text) for r in documents]
    shifted = labels.withColumn("doc_id", F.col("doc_id") + 1000)
    nulls = spark.createDataFrame([(None, 1, None), (5, None, None), (10**9, 1, 0)], labels.schema)
    docs = docs_of([*edge_rows, *rows])
    got = quality.score_documents(docs, shifted.unionByName(nulls)).collect()
    assert len(got) == len(edge_rows) + len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    kept = quality.keep_good(docs, shifted)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in got if r.score >= 0.5}
    assert {r.doc_id for r in kept.collect()} == good


@pytest.mark.parametrize("rows", [[], [(1, 1, 0)], [(None, None, None)]])
def test_without_training_rows(spark, docs_of, rows):
    labels = spark.createDataFrame(rows, "doc_id long,quality int,toxic int")
    assert [r.score for r in quality.score_documents(docs_of([(1, "a text")]), labels).collect()] == [0.5]
    assert quality.score_documents(docs_of([]), labels).collect() == []


def test_scores_equal_the_definition(spark):
    """Class densities from plain numpy covariances, their determinants and inverses, over the same statistics."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    x = {r.doc_id: quality.statistics(r.text) for r in docs.collect()}
    y = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.doc_id in x}
    rows = {k: np.array([x[i] for i in y if y[i] == k]) for k in (0, 1)}
    n = {k: len(rows[k]) for k in rows}
    assert min(n.values()) > 5
    own = {k: np.cov(rows[k].T, bias=True) for k in rows}
    pooled = sum(n[k] * own[k] for k in rows) / sum(n.values())
    density = []
    for k in (0, 1):
        weight = quality.SHRINK_TO_POOLED + (1 - quality.SHRINK_TO_POOLED) * quality.SIZE / (quality.SIZE + n[k])
        covariance = (1 - weight) * own[k] + weight * pooled
        share = quality.SHRINK_TO_DIAGONAL
        covariance = (1 - share) * covariance + share * np.diag(np.diag(pooled) + 1e-4)
        apart = {i: v - rows[k].mean(0) for i, v in x.items()}
        inverse, log_det, prior = np.linalg.inv(covariance), np.linalg.slogdet(covariance)[1], np.log(n[k] / sum(n.values()))
        density.append({i: prior - 0.5 * log_det - 0.5 * d @ inverse @ d for i, d in apart.items()})
    margin = {i: density[1][i] - density[0][i] for i in x}
    loss = {t: sum(np.logaddexp(0, -np.clip((margin[i] if y[i] else -margin[i]) / t, -500, 500)) for i in y) for t in quality.TEMPERATURES}
    best = min(quality.TEMPERATURES, key=lambda t: loss[t])
    got = quality.score_documents(docs, labels).collect()
    for r in got:
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(margin[r.doc_id] / best, -500, 500))), rel=1e-4, abs=1e-9)
