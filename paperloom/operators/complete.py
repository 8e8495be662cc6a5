"""Completion: what a fetched response means, and joining completed fields to the raw papers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.extract import completed_authors
from paperloom.operators.worklist import VALUES, best_outcome
from paperloom.schemas import DONE, ERROR, TODO

FORBIDDEN = 403

# Response keys, all of which must be present (a null value is fine).
VENUE, YEAR, CITATIONS = "venue", "year", "citationCount"


def with_state(responses: DataFrame) -> DataFrame:
    """Add `state`: DONE, ERROR, or TODO for a response that leaves its paper open; and the values of a done one.

    A body that is not JSON is an error whatever the status. Otherwise 403 leaves the paper open. Otherwise
    an object without a non-null `error` and with plain values under all three keys is done; anything else
    is an error.
    """
    # Projections of their own, so that each body is parsed and each key looked up once.
    parsed = responses.withColumn("_parsed", F.try_parse_json("body"))
    keys = {f"_{k}": F.try_variant_get("_parsed", f"$.{k}", "variant") for k in ("error", VENUE, YEAR, CITATIONS)}
    is_object = F.schema_of_variant("_parsed").startswith("OBJECT")
    has_error = F.col("_error").isNotNull() & ~F.is_variant_null("_error")
    # A list or an object cannot be stored as a value; a missing key gives NULL and fails the test as well.
    kinds = F.concat(*[F.schema_of_variant(f"_{k}") for k in (VENUE, YEAR, CITATIONS)])
    has_keys = F.coalesce(~kinds.rlike("OBJECT|ARRAY"), F.lit(False))
    state = (
        F.when(F.col("_parsed").isNull(), ERROR)
        .when(F.col("status") == FORBIDDEN, TODO)
        .when(is_object & ~has_error & has_keys, DONE)
        .otherwise(ERROR)
    )
    done = F.col("state") == DONE
    values = {
        "venue": F.when(done, F.try_variant_get(f"_{VENUE}", "$", "string")),
        "year": F.when(done, F.try_variant_get(f"_{YEAR}", "$", "int")),
        "n_citations": F.when(done, F.try_variant_get(f"_{CITATIONS}", "$", "int")),
    }
    return parsed.withColumns(keys).withColumn("state", state).withColumns(values).drop("_parsed", *keys)


def settled_responses(responses: DataFrame) -> DataFrame:
    """One settling outcome per id. Repeated responses are folded before the shuffle; a done one wins, and of
    several done ones the one with more values present.

    Open responses take part and lose, and ids with nothing else are left out at the end: the optimizer would push
    a filter on the state below the parsing and so parse again in it.
    """
    return (
        with_state(responses)
        .groupBy("id")
        .agg(best_outcome(F.col("state")).alias("o"))
        .filter(F.col("o.filled") != TODO)
        .select("id", "o.filled", *[f"o.{v}" for v in VALUES])
    )


def complete(pending: DataFrame, responses: DataFrame) -> DataFrame:
    """New staging rows: every pending paper whose response settles it, as done or as an error."""
    return pending.join(settled_responses(responses), "id").select(
        "id", "venue", "year", "n_citations", "partition", "filled"
    )


def completed_papers(raw: DataFrame, main: DataFrame) -> DataFrame:
    """Raw papers joined to their completed fields.

    Rows that are done and whose venue is not the empty string; a NULL venue is kept. Ids are distinct in
    `main`, so repeated raw rows are the only possible skew, which AQE splits on the raw side.
    """
    done = main.filter((F.col("filled") == DONE) & ~F.col("venue").eqNullSafe("")).select(
        "id", "year", "venue", "n_citations"
    )
    return completed_authors(raw).join(done, "id")
