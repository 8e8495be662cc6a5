"""Column functions against small Python models and the documented edge rows."""

import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text
from paperloom.functions.ordering import bucket, order_hash


def _apply(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def _random_strings(n, alphabet, longest=12):
    rng = random.Random(7)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_category_regex_is_case_sensitive(spark):
    values = ["physics.plasm-ph", "cs.PL", "math.OC cs.AI", "physics.soc-ph"]
    assert _apply(spark, values, lambda c: text.regex_search(c, r"cs\.PL")) == [False, True, False, False]
    umbrella = r"(^cs\.)|( cs\.)"
    assert _apply(spark, values, lambda c: text.regex_search(c, umbrella)) == [False, True, True, False]


@pytest.mark.parametrize(
    "pattern, value, expected",
    [
        ("(machine( |-)learning)", "On MACHINE-Learning", True),
        ("^second", "first\nSecond line", True),
        ("É", "é", True),
        ("b$", "b\r\nc", False),
        ("b$", "b\nc", True),
        ("", "anything", True),
    ],
)
def test_topic_regex(spark, pattern, value, expected):
    assert bool(re.search(pattern, value, re.I | re.M)) is expected
    assert _apply(spark, [value], lambda c: text.topic_match(c, F.lit(""), pattern)) == [expected]
    assert _apply(spark, [value], lambda c: text.topic_match(F.lit("zzz"), c, pattern)) == [expected]


def test_topic_of_missing_fields(spark):
    assert _apply(spark, [None], lambda c: text.topic_match(c, F.lit("nlp"), "nlp")) == [None]
    assert _apply(spark, [None], lambda c: text.topic_match(F.lit("x"), c, "nlp")) == [None]
    assert _apply(spark, [None], lambda c: text.topic_match(F.lit("nlp"), c, "nlp")) == [True]


@pytest.mark.parametrize("pattern", [r"a(b|-)c", r"^b", r"c$", r"\bab\b", r"[a-c]{3}", r"\w+é", r"(a|b)+ c"])
def test_topic_regex_model(spark, pattern):
    values = _random_strings(400, "abcABCéÉ -\n")
    expected = [re.search(pattern, v, re.I | re.M) is not None for v in values]
    assert _apply(spark, values, lambda c: text.topic_match(c, F.lit("§"), pattern)) == expected


def test_title_key_edges(spark):
    values = ["Deep-Learning: a 2nd Look", "12 345", "ΟΔΟΣ.", "İ", "éa", None, "ﬁne", "東京 2020", "𝒜b"]
    expected = [None if v is None else "".join(c for c in v if c.isalpha()).lower() for v in values]
    assert expected[:3] == ["deeplearningandlook", "", "οδος"]
    assert _apply(spark, values, text.title_key) == expected


def test_title_key_model(spark):
    alphabet = "abcXYZ019 .,-_éÉßΣσςΩЖж東京́İı²Ⅷªאا\n\t"
    values = _random_strings(2_000, alphabet, 20)
    assert _apply(spark, values, text.title_key) == ["".join(c for c in v if c.isalpha()).lower() for v in values]


def test_audit_titles(spark):
    values = ["two\n  lines", "a   b", "a    b"]
    squeezed = [v.replace("\n", "").replace("  ", " ") for v in values]
    assert _apply(spark, values, lambda c: text.audit_title(c, True)) == squeezed
    assert _apply(spark, values, lambda c: text.audit_title(c, False)) == ["two  lines", "a   b", "a    b"]


def test_names(spark):
    assert _apply(spark, [" s2-corpus-001.gz ", "plain"], text.shard_name) == ["s2-corpus-001", "plain"]
    paths = ["/data/completed_s2_arxiv_cslg_all_.data", "x.data"]
    assert _apply(spark, paths, text.source_label) == ["cslg", "x"]
    assert _apply(spark, ["cs_ml", "csai_all"], text.worklist_category) == ["cs", "csai"]


def test_crc_token(spark):
    values = ["", "1650000000.123", "é"]
    assert _apply(spark, values, text.crc_token) == [hex(zlib.crc32(v.encode())) for v in values]


def test_eta(spark):
    golden = ["24 hrs 59 min 36 sec", "0 hrs 00 min 00 sec", "0 hrs 00 min 03 sec", "100 hrs 00 min 00 sec"]
    assert _apply(spark, [29_992, 0, 1, 120_000], text.eta, "bigint") == golden


def test_author_names(spark):
    value = [["Doe", "Jane", "Jr"], ["Only"], ["", "Ann"]]
    got = _apply(spark, [value, [], None], text.author_names, "array<array<string>>")
    assert got == [["Jane Doe", None, "Ann "], [], None]


def test_json_text(spark):
    df = spark.createDataFrame([(1, None, ["a", "é"])], "id INT, venue STRING, authors ARRAY<STRING>")
    assert df.select(text.record_json("*")).first()[0] == '{"id":1,"authors":["a","é"]}'
    assert _apply(spark, ['["a", "\\u00e9"]'], text.decode_string_array) == [["a", "é"]]


def test_hash_prefix_follows_hash_order(spark):
    rows = spark.range(500).select(order_hash(F.col("id"), 1).alias("h")).select("h", bucket(F.col("h")).alias("b"))
    ordered = rows.orderBy("h").collect()
    assert [r.b for r in ordered] == sorted(r.b for r in ordered)
