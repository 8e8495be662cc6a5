"""Category and topic registry: which regex marks which label.

The registry is an ordinary Python value. Every operator takes it (or one entry) as a parameter, so
a caller can pass labels of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Category:
    name: str
    regex: str
    topics: dict[str, str] = field(default_factory=dict)


# Second-level Computer Science codes, in registry order (ties in counts keep this order).
CS_CODES = (
    "AI", "LG", "CV", "CL", "AR", "CC", "CE", "CG", "CR", "CY", "DB", "DC", "DL", "DM", "DS", "ET", "FL", "GL", "GR", "GT",
    "HC", "IR", "IT", "LO", "MA", "MM", "MS", "NA", "NE", "NI", "OH", "OS", "PF", "PL", "RO", "SC", "SD", "SE", "SI", "SY",
)

# Topic regexes per category. The empty regex matches every paper.
TOPICS = {
    "cs": {"ml": "(machine( |-)learning)", "nlp": "nlp"},
    "csai": {"all": ""},
    "cslg": {"all": ""},
    "cscv": {"all": ""},
    "cscl": {"all": ""},
}

# Fixed value: the umbrella category.
UMBRELLA = Category("cs", r"(^cs\.)|( cs\.)", TOPICS["cs"])


def default_registry() -> list[Category]:
    """The umbrella category, then one category per code, named after the lower-cased code."""
    second_level = [
        Category(f"cs{code.lower()}", rf"cs\.{code}", TOPICS.get(f"cs{code.lower()}", {})) for code in CS_CODES
    ]
    return [UMBRELLA, *second_level]


def second_level(registry: list[Category]) -> list[Category]:
    """The labels that get an index of matched papers."""
    return [c for c in registry if c.name != UMBRELLA.name]


def category(name: str, registry: list[Category] | None = None) -> Category:
    for entry in registry or default_registry():
        if entry.name == name:
            return entry
    raise KeyError(f"no category {name!r} in the registry")


def topic_regex(category_name: str, topic: str, registry: list[Category] | None = None) -> str:
    topics = category(category_name, registry).topics
    if topic not in topics:
        raise KeyError(f"no topic {topic!r} under category {category_name!r}")
    return topics[topic]


def label_table(spark: SparkSession, registry: list[Category]) -> DataFrame:
    """`(cate, ord)`, one row per registry entry, so that labels without papers still get a row."""
    rows = [(c.name, position) for position, c in enumerate(registry)]
    return spark.createDataFrame(rows, "cate STRING, ord INT")
