"""Shallow merge of JSON objects held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geoingest.functions.expr import let


def starts_object(text: Column) -> Column:
    """For valid JSON text: is it an object?"""
    return text.rlike(r"^\s*\{")


def is_json_object(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull() & starts_object(text), F.lit(False))


def json_map(text: Column) -> Column:
    """JSON object text as ``map<string,variant>``; null for anything else."""
    return F.when(starts_object(text), F.try_parse_json(text).cast("map<string,variant>"))


def json_merge(old: Column, new: Column) -> Column:
    """Keys of both objects; the new value wins, also when it is an explicit null."""

    def merged(pair: Column) -> Column:
        both = F.map_zip_with(
            json_map(pair["old"]), json_map(pair["new"]), lambda _, o, n: F.coalesce(n, o)
        )
        return (
            F.when(pair["new"].isNull(), pair["old"])
            .when(pair["old"].isNull(), pair["new"])
            .otherwise(F.to_json(both))
        )

    return let(F.struct(old.alias("old"), new.alias("new")), merged)


def keep_old(new: Column, old: Column) -> Column:
    return F.coalesce(new, old)
