"""Text functions: regex search, title keys, names, tokens, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex flags. d: only \n ends a line; U: Unicode classes and case; i: ignore case; m: ^ and $ per line.
CASE_SENSITIVE = "(?dU)"
IGNORE_CASE_MULTILINE = "(?imdU)"


def regex_search(text: Column, regex: str) -> Column:
    """Unanchored, case-sensitive search."""
    return text.rlike(CASE_SENSITIVE + regex)


def topic_match(title: Column, abstract: Column, regex: str) -> Column:
    """Case-insensitive multi-line search in the title, then in the abstract; NULL when undecidable."""
    pattern = IGNORE_CASE_MULTILINE + regex
    return F.when(title.isNotNull(), title.rlike(pattern) | abstract.rlike(pattern))


def title_key(title: Column) -> Column:
    """Letters only, lower case. A title without letters gives the empty key."""
    return F.lower(F.regexp_replace(title, r"[^\p{L}]", ""))


def audit_title(title: Column, squeeze: bool) -> Column:
    """One-line title for the match audit; `squeeze` also turns double spaces into single ones."""
    line = F.replace(title, F.lit("\n"), F.lit(""))
    return F.replace(line, F.lit("  "), F.lit(" ")) if squeeze else line


# Endings that tell the format and the compression of a file.
FORMAT_ENDINGS = r"(\.(jsonl?|ndjson|txt))?(\.(gz|bz2|zst|lz4|snappy|deflate))?$"


def shard_name(file_name: Column) -> Column:
    """The whole file name without its format and compression endings, so that different files differ."""
    return F.regexp_replace(F.trim(file_name), FORMAT_ENDINGS, "")


def decoded_path(encoded: Column) -> Column:
    """A path or file name as file metadata has it (percent-encoded), in plain characters."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def source_label(path: Column) -> Column:
    """Short name of a variant source file, from its path."""
    name = base_name(path)
    # File-name parts that carry no information (the reader of the result expects them gone).
    for part in (".data", "completed_s2_arxiv_", "_all_"):
        name = F.replace(name, F.lit(part), F.lit(""))
    return name


def worklist_category(worklist_name: Column) -> Column:
    """Category of a work-list named `<category>_<topic>`."""
    return F.split_part(worklist_name, F.lit("_"), F.lit(1))


def crc_token(text: Column) -> Column:
    """CRC-32 as lower-case hexadecimal with a 0x prefix."""
    return F.concat(F.lit("0x"), F.lower(F.hex(F.crc32(text.cast("binary")))))


def author_names(parsed: Column) -> Column:
    """`[last, first, ...]` pairs to `first last`, in order; a pair that is too short gives a NULL name."""
    return F.transform(parsed, lambda p: F.concat(F.get(p, F.lit(1)), F.lit(" "), F.get(p, F.lit(0))))


def eta(pending: Column, seconds_per_row: int = 3) -> Column:
    """Time left at a fixed pace, as `H hrs MM min SS sec` (fixed value: the format)."""
    seconds = pending.cast("bigint") * F.lit(seconds_per_row).cast("bigint")
    hours = (seconds / 3600).cast("bigint")
    minutes = (F.pmod(seconds, F.lit(3600)) / 60).cast("bigint")
    return F.format_string("%d hrs %02d min %02d sec", hours, minutes, F.pmod(seconds, F.lit(60)))


def record_json(*columns) -> Column:
    """One row as JSON text without its NULL fields."""
    return F.to_json(F.struct(*columns))


def decode_string_array(text: Column) -> Column:
    """JSON array of strings to an array column."""
    return F.from_json(text, "array<string>")
