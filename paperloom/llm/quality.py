"""Quality classifier: regularised quadratic discriminant over document statistics (operator 1).

Each whole text becomes a vector of transformed statistics (lengths, shares of kinds of characters, repetition, line
shape). Per class a mean and a shrinkage covariance are estimated; the score of a text is the posterior of class 1 from
the difference of the two Mahalanobis log densities, whose Cholesky factors are computed once and cached. A temperature
fitted on the training rows calibrates the score.

Moments are sums over all labelled training rows, added up by Spark: what reaches the driver is one small matrix per
class, whatever the size of the corpus.

Nulls count as the empty text, which has statistics like any other. Label rows with a null id or quality, and ids
without a document, are not learned from; a label or document row that is repeated counts as often as it occurs. With
no training row of one class every score is 0.5; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.tables import id_text, map_texts
from paperloom.session import durable

FOLDS, HELD_OUT = 3, 1  # rows with crc32(doc_id) % 3 == 1 are never learned from
SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL = 0.1, 0.05
TEMPERATURES = (0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0)
FLOOR = 5.0  # pseudo-count of a share: keeps its logarithm finite, and the shares of very short texts near the middle

_UPPER, _LOWER, _DIGIT = slice(0x41, 0x5B), slice(0x61, 0x7B), slice(0x30, 0x3A)
_MARKS = {"stops": b".?", "commas": b",;:", "shouts": b"!", "bars": b"|", "odd": b"#$%&*<>=@\\^_~{}[]+/", "quotes": b"\"'()-"}
NAMES = (
    "chars", "words", "word_chars", "word_spread", "distinct_words", "commonest_word", "lines", "line_chars",
    "distinct_lines", "upper", "digits", "high", "space", *_MARKS, "short_words", "entropy", "upper_words", "compressible",
)
SIZE = len(NAMES)


def _share(part: float, whole: float) -> float:
    """Log odds of a share."""
    return math.log((part + FLOOR) / (max(whole - part, 0) + FLOOR))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a text."""
    text = text or ""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, words, lines = len(raw), text.split(), text.split("\n")
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    tally: dict[str, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    commonest = max(tally.values(), default=0)
    used = counts[counts > 0] / max(size, 1)
    n_lines = len(lines)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        math.log1p(size),
        math.log1p(n),
        math.log1p(float(lengths.mean()) if n else 0.0),
        math.log1p(float(lengths.std()) if n else 0.0),
        _share(len(tally), n),
        _share(commonest, n),
        math.log1p(n_lines),
        math.log1p(size / n_lines),
        _share(len(set(lines)), n_lines),
        _share(int(counts[_UPPER].sum()), size),
        _share(int(counts[_DIGIT].sum()), size),
        _share(int(counts[0x80:].sum()), size),
        _share(int(counts[32] + counts[9:14].sum()), size),
        *(_share(int(counts[list(marks)].sum()), size) for marks in _MARKS.values()),
        _share(int((lengths <= 3).sum()), n),
        float(-(used * np.log2(used)).sum()),
        _share(sum(word[0].isupper() for word in words), n),
        _share(pairs, max(n - 1, 0)),
    ]


def featurise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and statistics x of each whole text."""
    return map_texts(id_text(docs, id_col, text_col), lambda: lambda text: (statistics(text),), "doc_id long,x array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether the id's fold is kept from learning (a null id counts as kept)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


@dataclass
class Discriminant:
    """Class means, cached inverse Cholesky factors and log determinants."""

    means: list[np.ndarray]
    whiten: list[np.ndarray]
    log_det: list[float]
    log_prior: list[float]
    temperature: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with priors."""
        density = []
        for mean, whiten, log_det, prior in zip(self.means, self.whiten, self.log_det, self.log_prior, strict=True):
            z = (x - mean) @ whiten.T
            density.append(prior - 0.5 * log_det - 0.5 * (z * z).sum(1))
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x) / self.temperature, -500, 500)))


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products per class, added up in tasks before they are shuffled."""

    def partial(batches):
        sums = {}
        for batch in batches:
            if not len(batch):
                continue
            y, x = batch.y.to_numpy(), np.stack(batch.x.to_numpy())
            for k in (0, 1):
                own = x[y == k]
                moments = np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
                sums[k] = sums.get(k, 0) + moments
        for k, moments in sums.items():
            yield pd.DataFrame({"y": k, "pos": np.arange(len(moments)), "s": moments})

    rows = labelled.mapInPandas(partial, "y int,pos int,s double").groupBy("y", "pos").agg(F.sum("s").alias("s")).collect()
    out = {}
    for k in (0, 1):
        values = np.zeros(1 + SIZE + SIZE * SIZE)
        for row in rows:
            if row.y == k:
                values[row.pos] = row.s
        out[k] = values[0], values[1 : 1 + SIZE], values[1 + SIZE :].reshape(SIZE, SIZE)
    return out


def fit(features: DataFrame, labels: DataFrame) -> Discriminant | None:
    """Learn from the statistics of the labelled rows outside the held-out fold; None if a class has no row."""
    usable = labels.where(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")
    )
    labelled = features.join(usable, "doc_id").where(~held_out(F.col("doc_id"))).select("x", "y")
    sums = _moments(labelled)
    if any(sums[k][0] < 1 for k in sums):
        return None
    means = [sums[k][1] / sums[k][0] for k in (0, 1)]
    scatter = [sums[k][2] - sums[k][0] * np.outer(means[k], means[k]) for k in (0, 1)]
    total = sums[0][0] + sums[1][0]
    pooled = (scatter[0] + scatter[1]) / total
    scale = np.diag(pooled) + 1e-4
    whiten, log_det, log_prior = [], [], []
    for k in (0, 1):
        own = scatter[k] / sums[k][0]
        weight = SHRINK_TO_POOLED + (1 - SHRINK_TO_POOLED) * SIZE / (SIZE + sums[k][0])
        covariance = (1 - weight) * own + weight * pooled
        covariance = (1 - SHRINK_TO_DIAGONAL) * covariance + SHRINK_TO_DIAGONAL * np.diag(scale)
        factor = np.linalg.cholesky(covariance)
        whiten.append(np.linalg.inv(factor))
        log_det.append(2 * float(np.log(np.diag(factor)).sum()))
        log_prior.append(math.log(sums[k][0] / total))
    model = Discriminant(means, whiten, log_det, log_prior)
    # Choose the temperature of least log loss over the training rows.
    margins = labelled.select(_vector_udf(model.margin)("x").alias("m"), "y")
    signed = F.when(F.col("y") == 1, F.col("m")).otherwise(-F.col("m"))
    losses = margins.agg(
        *(F.sum(F.log1p(F.exp(F.greatest(F.lit(-500.0), F.least(F.lit(500.0), -signed / t))))) for t in TEMPERATURES)
    ).first()
    model.temperature = TEMPERATURES[int(np.argmin(losses))]
    return model


def _vector_udf(function):
    @F.pandas_udf("double")
    def apply(x: pd.Series) -> pd.Series:
        return pd.Series(function(np.stack(x.to_numpy())) if len(x) else [], dtype="float64")

    return apply


def text_score(model: Discriminant | None) -> "callable":
    """A column function from a text column to its score."""
    if model is None:
        return lambda text: F.lit(0.5)

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in texts])) if len(texts) else [], dtype="float64")

    return apply


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each whole text. Texts are read once: statistics are kept, texts are not."""
    features = durable(featurise(docs))
    model = fit(features, labels)
    score = F.lit(0.5) if model is None else _vector_udf(model.score)("x")
    return features.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs`, unchanged, whose text scores at least `threshold`."""
    model = fit(durable(featurise(docs)), labels)
    return docs.where(text_score(model)(F.col("text")) >= threshold)
