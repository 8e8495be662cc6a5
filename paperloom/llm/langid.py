"""Language identification by averaged hashed subword embeddings and a linear softmax (operator 8).

A text is the average of the embeddings of its subwords: byte 2-, 3- and 4-grams of the lower-cased letters with blanks
for everything else, hashed into BUCKETS rows. A linear layer and a softmax give the language. Both are trained with
stochastic gradient descent in numpy. Confidence is calibrated with a temperature on rows set aside, and `accepted`
tells whether it reaches the least confidence at which those rows were right often enough; the rest is rejected.

Training takes at most SAMPLE_PER_LANG documents of each language, those with the smallest hash of their id, over their
whole texts; what reaches the driver are their bucket counts. Scoring reads every whole text once: as averaging and the
linear layer commute, it adds up one row of a small table per subword.

A text that is null or has no letter is `und` with score 0 and not accepted. Without training rows every text is `und`.
Repeated rows give repeated results; rows without an id count as held out. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.tables import id_text, map_texts

FOLDS, HELD_OUT = 4, 2  # rows with crc32(doc_id) % 4 == 2 are never learned from
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 16
SAMPLE_PER_LANG, SAMPLE = 400, 2400  # documents learned from: per language, and in all
DRAWN = 4  # times as many ids of a language are drawn by their hash before they are ranked
EPOCHS, BATCH, RATE = 12, 32, 4.0
WANTED_PRECISION = 0.99
HASHED_AT_ONCE = 1 << 18  # bytes
UNDECIDED = "und"

_LETTER = regex.compile(r"\p{L}")
# Bytes of ASCII letters and of other scripts stay; all else becomes a blank.
_FOLD = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket's subwords occur in a text."""
    raw = b" ".join([b"", *text.lower().encode().translate(_FOLD).split(), b""])
    counts = np.zeros(BUCKETS, np.int64)
    for low in range(0, len(raw), HASHED_AT_ONCE):
        gram = part = np.frombuffer(raw[low : low + HASHED_AT_ONCE + 3], np.uint8).astype(np.uint32)
        for n in (2, 3, 4):
            gram = (gram[:-1] << np.uint32(8)) | part[n - 1 :]
            own = gram[:HASHED_AT_ONCE]  # the next stretch begins its own
            hashed = ((own ^ np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
            counts += np.bincount(hashed, minlength=BUCKETS)
    return counts


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x languages: embedding times linear layer
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, averages: np.ndarray) -> np.ndarray:
        return averages @ self.table + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(-1, keepdims=True))
        return e / e.sum(-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.langs or not _LETTER.search(text):
            return UNDECIDED, 0.0, False
        counts = bucket_counts(text)
        p = self.probabilities(self.logits(counts / max(1, counts.sum())))
        best = int(p.argmax())
        return self.langs[best], float(p[best]), bool(p[best] >= self.least)


def train(averages: np.ndarray, y: np.ndarray, langs: list[str]) -> Model:
    """Stochastic gradient descent over mini-batches; a tenth of the rows is set aside for calibration."""
    rng = np.random.default_rng(8)
    order = rng.permutation(len(y))
    aside, used = order[: len(y) // 10], order[len(y) // 10 :]
    embedding = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * -(-len(used) // BATCH), 0
    # Averages of many subwords are small; the mean length gives the hidden layer unit scale.
    scale = np.float32(1 / max(1e-6, float(np.sqrt((averages**2).sum(1).mean()))))
    for _ in range(EPOCHS):
        for low in range(0, len(used), BATCH):
            rows = used[low : low + BATCH]
            x = averages[rows] * scale
            hidden = x @ embedding
            logits = hidden @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(rows)), y[rows]] -= 1
            p *= RATE * (1 - step / steps) / len(rows)
            back = p @ layer.T
            layer -= 0.1 * (hidden.T @ p)
            bias -= 0.1 * p.sum(0)
            embedding -= x.T @ back
            step += 1
    model = Model(langs, (embedding @ layer * scale).astype(np.float64), bias.astype(np.float64))
    if len(aside):
        logits, truth = model.logits(averages[aside]), y[aside]
        losses = []
        for t in (0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 5.0):
            model.temperature = t
            p = model.probabilities(logits)[np.arange(len(aside)), truth]
            losses.append((-np.log(np.maximum(p, 1e-12)).mean(), t))
        model.temperature = min(losses)[1]
        p = model.probabilities(logits)
        sure, right = p.max(1), p.argmax(1) == truth
        for least in sorted({0.0, *sure.tolist()}):
            kept = sure >= least
            if right[kept].mean() >= WANTED_PRECISION:
                break
        model.least = least
    return model


def held_out(doc_id: Column) -> Column:
    """Whether the id's fold is kept from learning (a null id counts as kept)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def fit(docs: DataFrame) -> Model:
    """Learn from `text` and `lang` of a bounded sample outside the held-out fold."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang")
    )
    # An id with several languages is learned as the first of them.
    ids = known.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("h", F.xxhash64("doc_id"))
    # A share of each language's ids, by hash, is sure to hold the first ones in hash order; only these few are ranked.
    share = ids.groupBy("lang").agg((F.lit(DRAWN * SAMPLE_PER_LANG) / F.count("*")).alias("share"))
    drawn = ids.join(share, "lang").where(F.col("h") / F.lit(2.0**64) + 0.5 < F.col("share"))
    by_hash = Window.partitionBy("lang").orderBy("h", "doc_id")
    ranked = drawn.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= SAMPLE_PER_LANG)
    chosen = ranked.orderBy("n", "lang").limit(SAMPLE).select("doc_id", "lang").collect()
    if not chosen:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    sample = docs.sparkSession.createDataFrame([(r.doc_id, r.lang) for r in chosen], "doc_id long,own string")
    texts = known.join(F.broadcast(sample), "doc_id").where("lang = own")

    def start():
        def sparse(text):
            counts = bucket_counts(text)
            places = np.flatnonzero(counts)
            return places.astype(np.int32), np.minimum(counts[places], 2**31 - 1).astype(np.int32)

        return sparse

    rows = (
        map_texts(texts.select("doc_id", "text"), start, "doc_id long,places array<int>,counts array<int>")
        .dropDuplicates(["doc_id"]).collect()
    )
    rows.sort(key=lambda r: r.doc_id)
    lang_of = {r.doc_id: r.lang for r in chosen}
    langs = sorted({lang_of[r.doc_id] for r in rows})
    averages = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        averages[i, r.places] = np.array(r.counts) / max(1, sum(r.counts))
    return train(averages, np.array([langs.index(lang_of[r.doc_id]) for r in rows]), langs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and accepted of each whole text."""
    schema = "doc_id long,lang_pred string,score double,accepted boolean"
    return map_texts(id_text(docs, id_col, text_col), lambda: model.predict, schema)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted; the model is learned from the same table's other folds."""
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")
