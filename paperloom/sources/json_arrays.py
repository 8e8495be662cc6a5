"""JSON arrays of any layout as a splittable source.

An array may stand on one line, be pretty-printed or have one object per line: a file is cut at every `}` and so read in
splits, whatever its lines are. What a `}` means depends on what stands before it, so reading takes two looks:

1. Every split is summed up without knowing how it begins: whether it turns the inside of a text into the outside, how much
   deeper it leads, and how many `}` end at which depth, each for a begin inside and outside of a text.
2. Prefix sums over the splits of a file give each its true begin (inside a text or not, depth, records ended before).
   Splits are then cut where a `}` leads back to depth 1. A record within a split is whole; the ends of a split are joined
   to their neighbours by the number of the record.

Only the splits' sums and the records at their borders are shuffled. A file that is no array, an element that is no object
and a record that is no JSON of the schema are errors that name the file or the text; nothing is read as a null row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from paperloom import schemas
from paperloom.session import durable

CUT = "}"
ESCAPE = re.compile(r"\\.", re.DOTALL)
SUMS = (
    "file string, block long, opening string, flips int, deeper_outside long, deeper_inside long, "
    "ends_outside map<long, long>, ends_inside map<long, long>"
)
CUTS = "file_no long, record_no long, block long, kind int, text string"
WHOLE, PIECE, REST = 0, 1, 2  # a record, a part of one, and what follows the last one
# Splits whose begins are sent to every task (some 100 bytes each); beyond it fragments are dealt to their split instead.
BROADCAST_BLOCKS = 500_000
# Fragments that are Python's texts at once, and characters of records that are handed on at once: a task holds one batch
# in Arrow's form, which Spark bounds by rows and bytes, and small parts of it beside that.
AT_ONCE, HANDED_ON = 128, 2_000_000


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Text between two `}` in the order of the file, with its file and the place where its split begins."""
    place = {"file": "_metadata.file_path", "block": "_metadata.file_block_start"}
    return spark.read.option("lineSep", CUT).text(path).select(*[F.col(c).alias(n) for n, c in place.items()], "value")


def _apart(fragment: str) -> list[str]:
    """The fragment cut at its quotes: every second part is on the same side of them."""
    return (ESCAPE.sub("", fragment) if "\\" in fragment else fragment).split('"')


def _deeper(parts: list[str]) -> int:
    text = "".join(parts)
    return text.count("{") + text.count("[") - text.count("]")


class _Sums:
    """Sums of one split for a begin outside (0) and inside (1) of a text."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.opening = file, block, ""
        self.flips, self.deeper, self.ends = 0, [0, 0], [Counter(), Counter()]

    def add(self, fragment: str) -> None:
        if not self.opening:
            self.opening = fragment.lstrip(" \t\r\n")[:1] or (CUT if fragment else "")
        parts = _apart(fragment)
        change, flip = (_deeper(parts[0::2]), _deeper(parts[1::2])), (len(parts) - 1) & 1
        for begin in (0, 1):
            inside = begin ^ self.flips
            self.deeper[begin] += change[inside]
            if not inside ^ flip:
                self.deeper[begin] -= 1
                self.ends[begin][self.deeper[begin]] += 1
        self.flips ^= flip

    def row(self) -> tuple:
        ends = [list(e.items()) for e in self.ends]
        return self.file, self.block, self.opening, self.flips, *self.deeper, *ends


_SUMS_TYPES = (
    pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.map_(pa.int64(), pa.int64()), pa.map_(pa.int64(), pa.int64()),
)
_CUTS_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())


def _batch(rows: list[tuple], types: tuple, schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    names = [part.split()[0] for part in re.split(r", (?![^<]*>)", schema)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            yield from zip(*(column.to_pylist() for column in batch.slice(start, AT_ONCE).columns), strict=True)
        del batch  # else it would stay while the next one is read


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = None
    for file, block, fragment in _rows(batches):
        if sums is None or sums.block != block or sums.file != file:
            if sums is not None:
                yield _batch([sums.row()], _SUMS_TYPES, SUMS)
            sums = _Sums(file, block)
        sums.add(fragment)
    if sums is not None:
        yield _batch([sums.row()], _SUMS_TYPES, SUMS)


def _begins(sums: DataFrame) -> DataFrame:
    """How each split begins: inside a text or not, depth, records ended before; and whether it is its file's last."""
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    inside = F.col("inside") == 1
    return (
        sums.withColumn("inside", earlier(F.col("flips").cast("long")) % 2)
        .withColumn("deeper", F.when(inside, F.col("deeper_inside")).otherwise(F.col("deeper_outside")))
        .withColumn("depth", earlier("deeper"))
        .withColumn("ends", F.when(inside, F.col("ends_inside")).otherwise(F.col("ends_outside")))
        .withColumn("ended", F.coalesce(F.try_element_at("ends", 1 - F.col("depth")), F.lit(0)))
        .withColumn("record_no", earlier("ended"))
        .withColumn("last", F.lead("block").over(order).isNull())
        .withColumn("file_no", F.xxhash64("file"))
    )


def _check(begins: DataFrame) -> None:
    """Fail on a file that is no array. Behind its last fragment no `}` stands, so an array's sums end at depth -1."""
    open_end = F.col("last") & ((F.col("depth") + F.col("deeper") != -1) | ((F.col("inside") + F.col("flips")) % 2 != 0))
    bad = begins.filter(((F.col("block") == 0) & (F.col("opening") != "[")) | open_end).select("file").first()
    if bad is not None:
        raise ValueError(f"no JSON array: {bad.file}")


class _Cutter:
    """Records and border pieces of one split."""

    def __init__(self, file_no: int, block: int, inside: int, depth: int, record_no: int, last: bool):
        self.file_no, self.block, self.inside, self.depth, self.record_no, self.last = file_no, block, inside, depth, record_no, last
        self.held: list[str] = []
        self.whole = block == 0

    def _row(self, kind: int, text: str) -> tuple:
        return self.file_no, self.record_no, self.block, kind, text

    def add(self, fragment: str) -> tuple | None:
        parts = _apart(fragment)
        self.depth += _deeper(parts[self.inside :: 2])
        self.inside ^= (len(parts) - 1) & 1
        self.held.append(fragment)
        if self.inside:
            return None
        self.depth -= 1
        if self.depth != 1:
            return None
        row = self._row(WHOLE if self.whole else PIECE, CUT.join([*self.held, ""]))
        self.held, self.whole = [], True
        self.record_no += 1
        return row

    def rest(self) -> list[tuple]:
        if not self.held:
            return []
        return [self._row(REST, CUT.join(self.held)) if self.last else self._row(PIECE, CUT.join([*self.held, ""]))]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cutter, rows, size = None, [], 0
    for fragment, *begin in _rows(batches):
        if cutter is None or (cutter.file_no, cutter.block) != (begin[0], begin[1]):
            if cutter is not None:
                rows += cutter.rest()
            if begin[2] is None:
                raise RuntimeError("the splits of the files have changed since they were summed up; read the path again")
            cutter = _Cutter(*begin)
        row = cutter.add(fragment)
        if row is not None:
            rows.append(row)
            size += len(row[-1])
        if size >= HANDED_ON:
            yield _batch(rows, _CUTS_TYPES, CUTS)
            rows, size = [], 0
    if cutter is not None:
        yield _batch([*rows, *cutter.rest()], _CUTS_TYPES, CUTS)


def _cuts(spark: SparkSession, path: str, broadcast_blocks: int) -> DataFrame:
    begins = durable(_begins(_fragments(spark, path).mapInArrow(_sum_up, SUMS)))
    _check(begins)
    begin = begins.select("file", "block", "file_no", F.col("inside").cast("int").alias("inside"), "depth", "record_no", "last")
    fragments = _fragments(spark, path)
    if begin.count() <= broadcast_blocks:
        placed = fragments.join(F.broadcast(begin), ["file", "block"], "left")
    else:
        numbered = fragments.withColumn("place", F.monotonically_increasing_id())
        placed = numbered.join(begin, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "place")
    # Numbers of columns, in the order in which _Cutter takes them.
    return placed.select("value", "file_no", "block", "inside", "depth", "record_no", "last").mapInArrow(_cut, CUTS)


def array_records(spark: SparkSession, path: str, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """The text of every record of the JSON arrays at a path."""
    cuts = _cuts(spark, path, broadcast_blocks)
    # At most two pieces and the rest for each split.
    pieces = durable(cuts.filter(F.col("kind") != WHOLE))
    parts = F.array_sort(F.collect_list(F.struct("block", "text")))
    joined = pieces.groupBy("file_no", "record_no").agg(
        F.max("kind").alias("kind"), F.array_join(F.transform(parts, lambda p: p.text), "").alias("text")
    )
    bad_rest = ~F.when(F.col("record_no") == 0, F.col("text").rlike(r"^\s*\[\s*\]\s*$")).otherwise(F.col("text").rlike(r"^\s*\]\s*$"))
    wrong = joined.filter((F.col("kind") == REST) & bad_rest).select(F.substring("text", 1, 200).alias("text")).first()
    if wrong is not None:
        raise ValueError(f"the array ends in something that is no record: {wrong.text!r}")
    whole = cuts.filter(F.col("kind") == WHOLE).select("record_no", "text")
    records = whole.unionByName(joined.filter(F.col("kind") != REST).select("record_no", "text"))
    fine = F.when(F.col("record_no") == 0, F.col("text").rlike(r"^\s*\[\s*\{")).otherwise(F.col("text").rlike(r"^\s*,\s*\{"))
    stray = F.raise_error(F.concat(F.lit("an element of the array is no object: "), F.substring("text", 1, 200)))
    return records.select(F.when(fine, F.expr("substr(text, instr(text, '{'))")).otherwise(stray).alias("record"))


def read_json_array(
    spark: SparkSession, path: str, schema: StructType = schemas.CATEGORY_PAPERS, broadcast_blocks: int = BROADCAST_BLOCKS
) -> DataFrame:
    """The records of the JSON arrays at a path (each file is one array), in any layout."""
    checked = StructType([*schema.fields, StructField(schemas.CORRUPT, schemas.TEXT)])
    parsed = F.from_json("record", checked, {"columnNameOfCorruptRecord": schemas.CORRUPT})
    bad = F.raise_error(F.concat(F.lit("a record does not fit the schema: "), F.substring(f"r.{schemas.CORRUPT}", 1, 200)))
    rows = array_records(spark, path, broadcast_blocks).select(parsed.alias("r"))
    return rows.select(F.when(F.col(f"r.{schemas.CORRUPT}").isNull(), F.col("r")).otherwise(bad).alias("r")).select(
        *[F.col("r").getField(name).alias(name) for name in schema.fieldNames()]
    )
