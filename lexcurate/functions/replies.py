"""Scores read from the JSON replies of an external scorer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexcurate.functions.text import let, strip, without_fence


def parsed_reply(content: Column) -> Column:
    """``struct<score int, reasoning string, error string>`` of a reply.

    ``score`` is a whole number from 0 to 5: fractions are cut off, digits in a string count, ``true`` is 1 and ``false`` 0;
    anything else, a reply that is no JSON object, or null is an error that quotes the first 100 characters. ``reasoning`` is
    ``''`` if absent and ``None`` for JSON null.
    """
    return let(without_fence(strip(content)), lambda body: let(F.try_parse_json(body), lambda data: _parsed(body, data)))


def _parsed(body: Column, data: Column) -> Column:
    parts = F.struct(
        F.startswith(F.schema_of_variant(data), F.lit("OBJECT")).alias("is_object"),
        F.schema_of_variant(F.try_variant_get(data, "$.score", "variant")).alias("kind"),
        F.try_variant_get(data, "$.score", "string").alias("text"),
        F.schema_of_variant(F.try_variant_get(data, "$.reasoning", "variant")).alias("why_kind"),
        F.try_variant_get(data, "$.reasoning", "string").alias("why"),
    )
    error = F.concat(F.lit("Failed to parse: "), F.left(F.coalesce(body, F.lit("")), F.lit(100)), F.lit("..."))
    return let(parts, lambda p: let(_whole(p["kind"], p["text"]), lambda whole: _result(p, whole, error)))


def _whole(kind: Column, text: Column) -> Column:
    """The score as a whole number, cut towards zero; null if it is none."""
    number = (
        F.when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(kind == "STRING", F.when(text.rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"), F.regexp_replace(text, r"[\s_]", "").try_cast("double")))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double"))
    )
    return F.when(number.between(-1, 6), F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))).cast("int")


def _result(p: Column, whole: Column, error: Column) -> Column:
    reasoning = F.when(p["why_kind"].isNull(), "").when(p["why_kind"] == "VOID", "None").when(p["why_kind"] == "BOOLEAN", F.initcap(p["why"])).otherwise(p["why"])
    good = F.coalesce(p["is_object"] & whole.between(0, 5), F.lit(False))
    return F.struct(F.when(good, whole).alias("score"), F.when(good, reasoning).alias("reasoning"), F.when(~good, error).alias("error"))
