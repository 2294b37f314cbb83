"""JSON texts as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A fixed value of this module: stands after the text, so that a parser that stops after one value cannot miss what follows.
_MARK = "end of payload"


def strict_json_sql(text: str) -> str:
    """SQL: the one value that ``text`` holds, null if it is no JSON or anything but blanks follows the value.

    Spark's parser reads the first value and leaves the rest; inside a list, with a mark behind it, the rest has to be valid.
    """
    listed = f"""try_parse_json(concat('[', {text}, ',"{_MARK}"]'))"""
    alone = f"coalesce(try_variant_get(w, '$[1]', 'string') = '{_MARK}', false) and try_variant_get(w, '$[2]', 'variant') is null"
    return f"get(transform(array({listed}), w -> if({alone}, try_variant_get(w, '$[0]', 'variant'), null)), 0)"


def strict_json(text: Column) -> Column:
    """Like ``strict_json_sql`` for a column."""
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_MARK}"]')))
    alone = F.coalesce(F.try_variant_get(listed, "$[1]", "string") == _MARK, F.lit(False)) & F.try_variant_get(listed, "$[2]", "variant").isNull()
    return F.when(alone, F.try_variant_get(listed, "$[0]", "variant"))


def with_strict_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``strict_json`` of a column as column ``out``; the parsed list is a column on the way, so that all of it is compiled."""
    listed = df.withColumn("__listed", F.expr(f"""try_parse_json(concat('[', {text}, ',"{_MARK}"]'))"""))
    alone = f"try_variant_get(__listed, '$[1]', 'string') = '{_MARK}' and try_variant_get(__listed, '$[2]', 'variant') is null"
    return listed.withColumn(out, F.expr(f"case when {alone} then try_variant_get(__listed, '$[0]', 'variant') end")).drop("__listed")
