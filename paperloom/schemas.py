"""Explicit schemas of every file and table. An absent JSON key and a JSON null both read as NULL."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, IntegerType, LongType, StringType, StructField, StructType

TEXT, INT, BIGINT = StringType(), IntegerType(), LongType()
TEXTS = ArrayType(TEXT)


def _schema(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


SNAPSHOT = _schema(
    ("id", TEXT),
    ("submitter", TEXT),
    ("authors", TEXT),
    ("title", TEXT),
    ("comments", TEXT),
    ("journal-ref", TEXT),
    ("doi", TEXT),
    ("report-no", TEXT),
    ("categories", TEXT),
    ("license", TEXT),
    ("abstract", TEXT),
    ("versions", ArrayType(_schema(("version", TEXT), ("created", TEXT)))),
    ("update_date", TEXT),
    ("authors_parsed", ArrayType(TEXTS)),
)

CATEGORY_PAPERS = _schema(
    ("id", TEXT), ("title", TEXT), ("abstract", TEXT), ("report-no", TEXT), ("authors_parsed", ArrayType(TEXTS))
)

WORKLIST = _schema(
    ("id", TEXT), ("venue", TEXT), ("year", INT), ("n_citations", INT), ("partition", INT), ("filled", INT)
)

RESPONSES = _schema(("id", TEXT), ("status", INT), ("body", TEXT))

CHECKLIST = _schema(("partition", TEXT), ("is_checked", INT))

SHARD_RECORD = _schema(
    ("id", TEXT),
    ("title", TEXT),
    ("paperAbstract", TEXT),
    ("authors", ArrayType(_schema(("name", TEXT)))),
    ("inCitations", TEXTS),
    ("fieldsOfStudy", TEXTS),
    ("venue", TEXT),
    ("year", INT),
)

# A shard line that is no JSON object of this shape is kept here while shards are read, to be counted.
CORRUPT = "_corrupt_record"
SHARD_LINE = StructType([*SHARD_RECORD.fields, StructField(CORRUPT, TEXT)])

# `title_key` is stored so that a title match reads a key instead of computing it for the whole corpus.
PAPERS = _schema(
    ("id", BIGINT),
    ("s2_id", TEXT),
    ("title", TEXT),
    ("abstract", TEXT),
    ("authors", TEXTS),
    ("venue", TEXT),
    ("year", INT),
    ("n_citations", INT),
    ("title_key", TEXT),
    ("partition", TEXT),
)

# Ingestion bookkeeping: one row per shard and scan task of a batch, and one row per batch with the records passed over.
CHUNKS = _schema(("partition", TEXT), ("task", BIGINT), ("file", TEXT), ("first_place", BIGINT), ("n", BIGINT))
PASSED_OVER = _schema(
    ("total", BIGINT),
    ("unparsable", BIGINT),
    ("no_field_of_study", BIGINT),
    ("no_title", BIGINT),
    ("no_abstract", BIGINT),
)

# Field order of one exported paper; also the shape of seeds, variants and masking input.
PAPER_RECORD = _schema(
    ("id", BIGINT),
    ("s2_id", TEXT),
    ("title", TEXT),
    ("abstract", TEXT),
    ("venue", TEXT),
    ("authors", TEXTS),
    ("year", INT),
    ("n_citations", INT),
)

COMPLETED_RECORD = _schema(
    ("id", TEXT),
    ("title", TEXT),
    ("abstract", TEXT),
    ("report-no", TEXT),
    ("authors", TEXTS),
    ("year", INT),
    ("venue", TEXT),
    ("n_citations", INT),
)

# Fields of exported and of completed papers; the ones a record lacks are NULL and left out again.
MASK_INPUT = _schema(
    ("id", TEXT),
    ("s2_id", TEXT),
    ("title", TEXT),
    ("abstract", TEXT),
    ("report-no", TEXT),
    ("venue", TEXT),
    ("authors", TEXTS),
    ("year", INT),
    ("n_citations", INT),
)

LABEL_INDEX = _schema(("id", BIGINT), ("cate", TEXT))


def plus(schema: StructType, name: str, kind: DataType) -> StructType:
    """A copy with one more field (a partition column of the folder layout)."""
    return StructType([*schema.fields, StructField(name, kind)])


def without(schema: StructType, name: str) -> StructType:
    return StructType([f for f in schema.fields if f.name != name])


def only(schema: StructType, *names: str) -> StructType:
    return StructType([schema[name] for name in names])


# Status values of the work-list.
TODO, DONE, ERROR = 0, 1, 2
