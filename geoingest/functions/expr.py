"""Small expression helpers used by the other function modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name`` so that later filters use the computed value.

    A filter on a plain projected column is pushed below the projection and repeats the expression;
    a one-element generator is a boundary the optimizer does not push through.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def to_float(c: Column) -> Column:
    """Text to double, null when it is not a number.

    The JVM parser also reads type suffixes and hexadecimal floats, which are no numbers in a payload;
    their letters are spoiled first.
    """
    return F.translate(c, "dDfFpP", "xxxxxx").try_cast("double")


def json_string(value: Column) -> Column:
    """JSON text of a struct or map, explicit nulls kept."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))
