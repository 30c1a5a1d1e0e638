"""Enrichment of entities."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoingest.functions.expr import compute_once, let, to_float
from geoingest.functions.tracks import route_coordinates, stamp_track
from geoingest.functions.urls import ROUTE_BASE_URL, ROUTE_PROFILE, build_route_url

log = logging.getLogger(__name__)


def _finish(attrs: Column, body: Callable[[Column, Column], Column]) -> Column:
    """Finish as numbers are written: ``50`` and ``50.0`` stay apart, of ``50.10`` the last zero goes."""

    def number(path: str) -> Column:
        text = F.get_json_object(attrs, path)
        return F.when(to_float(text).isNotNull(), F.regexp_replace(text, r"(\.\d+?)0+$", "$1"))

    ends = F.struct(number("$.finish_lat").alias("lat"), number("$.finish_lon").alias("lon"))
    return let(ends, lambda v: body(v["lat"], v["lon"]))


def routable(geom: Column, attrs: Column) -> Column:
    """Has a start and a finish to route between."""
    both = _finish(attrs, lambda lat, lon: lat.isNotNull() & lon.isNotNull())
    return geom.isNotNull() & F.coalesce(both, F.lit(False))


def route_url(geom: Column, attrs: Column, *, base: str = ROUTE_BASE_URL, profile: str = ROUTE_PROFILE) -> Column:
    """Route request of an entity, null when it is not routable."""
    return _finish(attrs, lambda lat, lon: build_route_url(geom, lat, lon, base=base, profile=profile))


def enrich_tracks(
    entities: DataFrame, responses: DataFrame, *, base: str = ROUTE_BASE_URL, profile: str = ROUTE_PROFILE
) -> DataFrame:
    """Add the routed track to entities whose route was answered; all other rows pass unchanged.

    ``responses(url, status, body)`` holds one chosen response per url (see ``select_response``); its
    bodies are parsed before the join. Rows without a route get a join key of their own, so that they
    spread instead of meeting on null; a route shared by many entities is split by adaptive planning.
    """
    answered = responses.select(F.col("url").alias("_route"), "status", F.col("body").cast("string").alias("body"))
    tracks = compute_once(answered, "_track", route_coordinates(F.col("body"), F.col("status")))
    tracks = tracks.where("_track is not null").select("_route", "_track")
    own = F.concat(F.lit("#"), F.xxhash64("source", "source_id", "_pos").cast("string"))
    url = route_url(F.col("geom"), F.col("attrs"), base=base, profile=profile)
    return (
        entities.withColumn("_route", F.coalesce(url, own))
        .join(tracks, "_route", "left")
        .withColumn("attrs", stamp_track(F.col("attrs"), F.col("_track")))
        .select(*entities.columns)
    )


def enrich(df: DataFrame, enrichers: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Apply enrichers in order. One that cannot be applied is logged and leaves the rows as they are."""
    for fn in enrichers:
        try:
            out = fn(df)
            out.schema  # a plan that does not resolve fails here, not in the middle of the run
        except Exception as exc:  # noqa: BLE001
            log.warning("enricher %s left out: %s", getattr(fn, "__name__", fn), exc)
            continue
        df = out
    return df


def isolated(fn: Callable[[pd.DataFrame], pd.DataFrame], inputs: list[str], outputs: str) -> Callable[[DataFrame], DataFrame]:
    """An enricher that fails row by row: of a batch that ``fn`` fails on, only the bad rows stay as they were.

    ``fn`` takes the columns ``inputs`` of a batch and returns the columns ``outputs`` (a schema text), a row for each row. Where
    it raises, or returns what does not fit the schema, the batch is halved in the task until the rows at fault are alone; their error goes to
    ``_enrich_error``, where several enrichers' errors are joined. So a run costs the same jobs however many rows fail.
    """
    fields = T.StructType.fromDDL(outputs)
    names = fields.fieldNames()
    schema, result = to_arrow_schema(fields), T.StructType([*fields.fields, T.StructField("_error", T.StringType())])

    def attempt(rows: pd.DataFrame) -> list[pd.DataFrame]:
        try:
            out = fn(rows.reset_index(drop=True).copy())[names].reset_index(drop=True)
            if len(out) != len(rows):
                raise ValueError(f"{len(out)} rows for {len(rows)}")
            pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)
            return [out.assign(_error=None)]
        except Exception as exc:  # noqa: BLE001
            if len(rows) > 1:
                half = len(rows) // 2
                return attempt(rows.iloc[:half]) + attempt(rows.iloc[half:])
            return [pd.DataFrame([dict.fromkeys(names) | {"_error": f"{type(exc).__name__}: {exc}"[:1000]}])]

    @F.pandas_udf(result)
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = attempt(rows) if len(rows) else [pd.DataFrame(columns=[*names, "_error"])]
        return pd.concat([p.astype(object) for p in parts], ignore_index=True)

    def stage(df: DataFrame) -> DataFrame:
        found = df.withColumn("_found", run(F.struct(*[F.col(f"`{c}`") for c in inputs])))
        old = {f.name: F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType) for f in fields}
        failed = F.col("_found._error")
        errors = F.concat_ws("; ", *([F.col("_enrich_error")] if "_enrich_error" in df.columns else []), failed)
        new = {c: F.when(failed.isNull(), F.col("_found").getField(c)).otherwise(old[c]) for c in names}
        return found.withColumns({**new, "_enrich_error": F.nullif(errors, F.lit(""))}).drop("_found")

    return stage
