"""SimHash near-duplicates by the generalised pigeonhole principle (operator 6).

Each whole text gets a 64-bit fingerprint of its word shingles; texts whose fingerprints differ in at most four bits are
linked, and a component is everything that links reach. The search runs on distinct fingerprints:

1. Correlated bits are grouped into partitions, from the correlation matrix of all fingerprints.
2. Every partition gets its own threshold. If partition i may differ in t_i bits, and sum(t_i + 1) is one more than the
   bits allowed, then two linked fingerprints are within t_i in at least one partition. Thresholds (-1: the partition is
   not probed) come from dynamic programming over candidate counts, which are estimated from exact counts of all
   partition values; the number of partitions is chosen the same way.
3. Fingerprints are placed in the buckets of their partition values, probe those within the threshold, and are verified.

A bucket sends on a spanning forest of its links, not its pairs. Buckets beyond BUCKET_ROWS rows are cut into blocks and
every two blocks meet in one task, so that no task holds more than two blocks of a bucket.

A text without words (null, empty, blank) has fingerprint zero and is linked like any other. Rows without doc_id have a
component like any other; component_id is null if no row of the component has one. Repeated rows give repeated results;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.components import connected, local_roots
from paperloom.llm.tables import id_text, map_texts
from paperloom.session import durable

BITS, ALLOWED, SHINGLE, SEED = 64, 4, 4, 42
BUCKET_ROWS = 1024  # rows of a block of a bucket
MOST_THRESHOLD = 2  # of one partition
MOST_PARTITIONS = ALLOWED + 1
HASHED_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - SHINGLE + 1)
    starts = np.concatenate([[0], ends])[:n].tolist()
    stops = (ends[min(SHINGLE, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for low in range(0, n, HASHED_AT_ONCE):
        high = low + HASHED_AT_ONCE
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[low:high], stops[low:high], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint fp (signed) of each whole text."""
    return map_texts(id_text(docs, id_col, text_col), lambda: lambda text: (_signed(fingerprint(text)),), "doc_id long,fp long")


def _correlation(distinct: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits over all fingerprints."""

    def partial(batches):
        total = np.zeros((BITS + 1, BITS + 1))
        for batch in batches:
            raw = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(raw.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            bits = np.hstack([bits, np.ones((len(bits), 1))])
            total += bits.T @ bits
        yield pa.RecordBatch.from_pydict({"pos": np.arange(total.size), "s": total.ravel()})

    rows = distinct.mapInArrow(partial, "pos long,s double").groupBy("pos").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((BITS + 1) ** 2)
    for row in rows:
        total[row.pos] = row.s
    total = total.reshape(BITS + 1, BITS + 1)
    n = max(total[-1, -1], 1)
    mean = total[-1, :-1] / n
    covariance = total[:-1, :-1] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    return np.abs(covariance / np.outer(spread, spread))


def group_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into groups of nearly equal size; each takes the bit most correlated with it, one at a time."""
    free = set(range(len(correlation)))
    groups = []
    for i in range(parts):
        size = (len(free) + parts - i - 1) // (parts - i)
        group = [min(free, key=lambda b: (-max(correlation[b, o] for o in free if o != b) if len(free) > 1 else 0, b))]
        free.discard(group[0])
        while len(group) < size:
            bit = min(free, key=lambda b: (-correlation[b, group].mean(), b))
            group.append(bit)
            free.discard(bit)
        groups.append(sorted(group))
    return groups


def _ball(width: int, threshold: int) -> int:
    return sum(math.comb(width, t) for t in range(threshold + 1))


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost with sum(t + 1) == budget; costs[i][t + 1] is the cost of threshold t."""
    best = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t1, more in enumerate(row):
                option = cost + more, [*chosen, t1 - 1]
                if used + t1 <= budget and (used + t1 not in step or option < step[used + t1]):
                    step[used + t1] = option
        best = step
    return best[budget]


def _take(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    value = np.zeros(len(fp), np.int64)
    for place, bit in enumerate(bits):
        value |= ((fp >> bit) & 1) << place
    return value


def plan_search(distinct: DataFrame, allowed: int = ALLOWED) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed partition."""
    correlation = _correlation(distinct)
    layouts = {m: group_bits(correlation, m) for m in range(2, allowed + 2)}
    parts = [(m, i, bits) for m, groups in layouts.items() for i, bits in enumerate(groups)]

    def values(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for k, (_, _, bits) in enumerate(parts):
                yield pa.RecordBatch.from_pydict({"k": np.full(len(fp), k, np.int32), "v": _take(fp, bits)})

    counts = distinct.mapInArrow(values, "k int,v long").groupBy("k", "v").agg(F.count("*").cast("double").alias("n"))
    sums = {row.k: (row.n, row.nn) for row in counts.groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")).collect()}
    if not sums:
        return []
    plans = []
    for m, groups in layouts.items():
        costs = []
        for k, (own, _, bits) in enumerate(parts):
            if own == m:
                n, squares = sums[k]
                balls = [_ball(len(bits), t) for t in range(MOST_THRESHOLD + 1)]
                # A probe is a row to sort; candidates of a larger ball are taken to be as many per value as at home.
                costs.append([0.0, *(8 * n * ball + squares * ball / 2 for ball in balls)])
        cost, thresholds = allocate(costs, allowed + 1)
        plans.append((cost, [(bits, t) for bits, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(plans, key=lambda p: p[0])[1]


def _placed(distinct: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(part, v, fp, home): each fingerprint in its own bucket and, not at home, in those it probes."""
    masks = [
        [sum(1 << b for b in flip) for t in range(threshold + 1) for flip in itertools.combinations(range(len(bits)), t)]
        for bits, threshold in plan
    ]

    def place(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for part, (bits, _) in enumerate(plan):
                value = _take(fp, bits)
                for mask in masks[part]:
                    yield pa.RecordBatch.from_pydict(
                        {"part": np.full(len(fp), part, np.int32), "v": value ^ mask, "fp": fp, "home": np.full(len(fp), mask == 0)}
                    )

    return distinct.mapInArrow(place, "part int,v long,fp long,home boolean")


def _links_of(group: np.ndarray, fp: np.ndarray, home: np.ndarray, allowed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the verified links inside each group; rows of a group stand together.

    Rows are compared with the one d places on, for d = 1, 2, ... up to the largest group. Of two rows at least one must
    be at home. Links are thinned out to a forest whenever there are many.
    """
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    at = np.arange(len(group) - 1)
    d = 1
    while len(at):
        at = at[at + d < len(group)]
        at = at[group[at] == group[at + d]]
        close = np.bitwise_count((fp[at] ^ fp[at + d]).view(np.uint64)) <= allowed
        near = at[close & (home[at] | home[at + d])]
        if len(near):
            held.append((fp[near], fp[near + d]))
            size += len(near)
        if size > 500_000 or not len(at):
            a, b = _forest([(a, b), *held])
            held, size = [], 0
        d += 1
    return _forest([(a, b), *held])


def _forest(held) -> tuple[np.ndarray, np.ndarray]:
    a, b = (np.concatenate(x) for x in zip(*held, strict=True))
    if not len(a):
        return a, b
    nodes, roots = local_roots(a, b)
    inner = nodes != roots
    return nodes[inner], roots[inner]


def links(distinct: DataFrame, plan: list[tuple[list[int], int]], allowed: int = ALLOWED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints of at most `allowed` differing bits."""
    placed = _placed(distinct, plan)
    hot = (
        placed.groupBy("part", "v").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows)
        .select("part", "v", F.ceil(F.col("n") / bucket_rows).cast("int").alias("blocks"))
    )
    spread = placed.join(hot, ["part", "v"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # Block x meets every block y: the pair (smaller, larger) is the group, so each block is in as many as there are blocks.
    spread = spread.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        F.xxhash64("part", "v", F.least("own", "other"), F.greatest("own", "other")).alias("g"), "fp", "home"
    ).repartition("g").sortWithinPartitions("g")

    def search(batches):
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
                rest = columns if rest is None else [np.concatenate(x) for x in zip(rest, columns, strict=True)]
                cut = int(np.searchsorted(rest[0], rest[0][-1]))  # the last group may go on
            elif rest is None:
                return
            else:
                cut = len(rest[0])
            group, fp, home = (x[:cut] for x in rest)
            rest = [x[cut:] for x in rest]
            if cut > 1:
                a, b = _links_of(group, fp, home, allowed)
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    return spread.mapInArrow(search, "a long,b long")


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, least, root) of each distinct fingerprint: its smallest doc_id and the fingerprint that names its component."""
    per_print = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    plan = plan_search(per_print.select("fp"))
    if not plan:
        return per_print.withColumn("root", F.col("fp"))
    roots = connected(links(per_print.select("fp"), plan))
    return per_print.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id of each row."""
    prints = durable(fingerprints(docs))
    rooted = _rooted(prints)
    # Joined by a column that no shuffle has dealt out yet, so that the rows of a large component can be split.
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id")).selectExpr("root ^ 1L as k", "component_id")
    named = rooted.selectExpr("fp", "root ^ 1L as k").join(component, "k").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without the near-duplicates: of each component the row with the smallest doc_id stays.

    Rows without doc_id come after those with one; of several rows with that id, those of the smallest fingerprint, and of
    these the one whose columns come first as JSON text. All columns are kept as they are, whatever their names.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    prints = durable(fingerprints(docs, id_col, text_col))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp")
    first = prints.groupBy("fp").agg(F.min(order).alias("first"))
    kept = _rooted(prints).join(first, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.fp").alias("kept_fp"))
    # An id that one row holds names its row; only rows that share an id need their fingerprint again.
    shared = prints.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("shared_id"))
    same_id = F.col("kept_id").eqNullSafe(F.col("shared_id"))
    single = durable(kept.join(shared, same_id, "left_anti"))
    again = durable(kept.join(shared, same_id, "left_semi"))
    out = rows.join(single, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").select("row.*")
    if again.isEmpty():
        return out
    among = rows.join(again, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi").withColumn("fp", _fingerprint_column(F.col("text")))
    same_row = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("fp") == F.col("kept_fp"))
    chosen = among.join(again, same_row, "left_semi").groupBy("doc_id", "fp").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return out.unionByName(chosen.select("row.*"))


def _fingerprint_column(text: Column) -> Column:
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t)) for t in texts], dtype="int64")

    return fp(text)
