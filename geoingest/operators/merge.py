"""Keyed upsert, insert-only load, soft delete and dry run over entity tables.

The operators take the target and the incoming rows as DataFrames and return new DataFrames; writing
a version is left to ``geoingest.sinks.tables``. ``now`` is always passed in, so a rerun gives the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoingest.functions.coords import geojson_point
from geoingest.functions.jsonmerge import is_json_object, json_map, json_merge, keep_old
from geoingest.schemas import ENTITY_TABLE, INSERTED, KEY, SKIPPED, UPDATED

DO_UPDATE, DO_NOTHING = "DO_UPDATE", "DO_NOTHING"


def as_stored(entities: DataFrame) -> DataFrame:
    """Entity rows with the geometry in its stored form."""
    return entities.withColumn("geom", geojson_point(F.col("geom")))


def invalid_reason(attrs: Column | None = None) -> Column:
    """Why a table would refuse the row, null when it would not."""
    attrs = F.col("attrs") if attrs is None else attrs
    missing = [
        F.when(F.col(c).isNull(), F.lit(f"null value in column {c}"))
        for c in ("source", "source_id", "entity_type")
    ]
    return F.coalesce(*missing, F.when(~is_json_object(attrs), F.lit("attrs is not a JSON object")))


def reject_invalid(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to persist, and refused rows with their ``reason``."""
    checked = entities.withColumn("reason", invalid_reason())
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


# Parts a record is taken into for folding, and the fields that always follow the last row.
_FIELDS, _COUNTRY, _ATTRIBUTE = 0, 1, 2
_FIELDS_TYPE = "entity_type string, geom string, confidence double"


def given_pos() -> Column:
    """Place in the batch. A row without one has no order among the rows of its key and is refused."""
    return F.coalesce(F.col("_pos"), F.raise_error(F.lit("_pos is null: number the rows of the batch")))


def fold_batch(entities: DataFrame) -> DataFrame:
    """One row per key that has the effect of upserting its rows one by one in ``_pos`` order.

    Attributes merge from left to right, so each attribute keeps its last value; type, geometry and
    confidence are those of the last row even when null; the country is the last one given. A record is
    taken apart into one text per attribute, one for its other fields and one for a given country, and
    the latest of each is chosen by an aggregate that combines on the map side. A key that holds a large
    share of the batch thus leaves every map task as a handful of rows.
    """

    def part(kind: int, name: Column, text: Column) -> Column:
        return F.struct(F.lit(kind).cast("byte").alias("part"), name.alias("name"), text.alias("entry"))

    none = F.lit("")
    fields = F.to_json(F.struct("entity_type", "geom", F.col("confidence").cast("double").alias("confidence")))
    # An attribute travels as a JSON text of its own; a VARIANT would carry the key list of its object.
    attrs = F.transform(
        F.map_entries(json_map(F.col("attrs"))),
        lambda e: part(_ATTRIBUTE, e["key"], F.to_json(F.create_map(e["key"], e["value"]))),
    )
    country = F.filter(
        F.array(part(_COUNTRY, none, F.col("bbox_country"))), lambda p: p["entry"].isNotNull()
    )
    parts = entities.select(
        *KEY, given_pos().alias("_pos"), F.inline(F.concat(F.array(part(_FIELDS, none, fields)), country, attrs))
    )
    # Sorting by a hash first compares numbers, where sources and ids mostly share their first bytes.
    parts = parts.withColumn("_h", F.xxhash64(*KEY, "part", "name"))
    latest = parts.groupBy("_h", *KEY, "part", "name").agg(
        F.max_by("entry", "_pos").alias("entry"), F.count("*").alias("n")
    )

    def only(kind: int, value: str) -> Column:
        return F.when(F.col("part") == kind, F.col(value))

    entries = F.transform(
        F.array_sort(F.collect_list(only(_ATTRIBUTE, "entry"))),
        lambda e: F.substr(e, F.lit(2), F.length(e) - 2),
    )
    folded = latest.groupBy(*KEY).agg(
        F.from_json(F.max(only(_FIELDS, "entry")), _FIELDS_TYPE).alias("fields"),
        F.max(only(_COUNTRY, "entry")).alias("bbox_country"),
        F.max(only(_FIELDS, "n")).alias("n_rows"),
        F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")).alias("attrs"),
    )
    return folded.select(*KEY, "fields.*", "attrs", "bbox_country", "n_rows")


def first_of_batch(entities: DataFrame) -> DataFrame:
    """The first row per key in ``_pos`` order, with the number of rows of the key."""
    cols = ["entity_type", "geom", "attrs", "bbox_country", F.col("confidence").cast("double").alias("confidence")]
    return (
        entities.groupBy(*KEY)
        .agg(F.min_by(F.struct(*cols), given_pos()).alias("_first"), F.count("*").alias("n_rows"))
        .select(*KEY, "_first.*", "n_rows")
    )


def upsert_entities(
    target: DataFrame,
    entities: DataFrame,
    now: Column,
    *,
    on_conflict: str = DO_UPDATE,
    soft_delete: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """New target table, and per key what happened: ``(source, source_id, n_inserted, n_updated, n_skipped)``.

    ``entities`` must be valid (see ``reject_invalid``). Several rows of one key count as one insert
    followed by updates. With ``soft_delete`` an upsert re-activates a removed row.
    """
    if on_conflict not in (DO_UPDATE, DO_NOTHING):
        raise ValueError(f"on_conflict must be DO_UPDATE or DO_NOTHING, got {on_conflict!r}")
    now = now.cast("timestamp")
    stored = as_stored(entities)
    src = fold_batch(stored) if on_conflict == DO_UPDATE else first_of_batch(stored)
    # Keys are unique on both sides from here on, so the join has no hot key.
    both = target.alias("t").join(
        src.alias("s"), [F.col(f"t.{k}") == F.col(f"s.{k}") for k in KEY], "full_outer"
    )
    is_new = F.col("t.source").isNull()
    in_batch = F.col("s.source").isNotNull()
    n = F.col("s.n_rows")
    if on_conflict == DO_NOTHING:
        merged = both.select(*[_pick(c, is_new, F.col(f"t.{c}"), now) for c in ENTITY_TABLE.fieldNames()])
        again, none = "n_skipped", "n_updated"
    else:
        matched = {
            "attrs": json_merge(F.col("t.attrs"), F.col("s.attrs")),
            "bbox_country": keep_old(F.col("s.bbox_country"), F.col("t.bbox_country")),
            "last_seen_at": now,
            "removed_at": F.lit(None).cast("timestamp") if soft_delete else F.col("t.removed_at"),
        }
        # Fields without a rule of their own take the incoming value, null included.
        overwritten = {c: F.col(f"s.{c}") for c in ("entity_type", "geom", "confidence")}
        changes = {**overwritten, **matched}
        merged = both.select(
            *[
                _pick(
                    c,
                    is_new,
                    F.when(in_batch, changes[c]).otherwise(F.col(f"t.{c}")) if c in changes else F.col(f"t.{c}"),
                    now,
                )
                for c in ENTITY_TABLE.fieldNames()
            ]
        )
        again, none = "n_updated", "n_skipped"
    outcomes = both.where(in_batch).select(
        *[F.col(f"s.{k}").alias(k) for k in KEY],
        F.when(is_new, 1).otherwise(0).cast("bigint").alias("n_inserted"),
        F.when(is_new, n - 1).otherwise(n).alias(again),
        F.lit(0).cast("bigint").alias(none),
    )
    return merged, outcomes.select(*KEY, "n_inserted", "n_updated", "n_skipped")


def _pick(name: str, is_new: Column, kept: Column, now: Column) -> Column:
    """Column of the merged table: the incoming value for a new key, else ``kept``."""
    if name in ("last_seen_at", "created_at"):
        fresh = now
    elif name == "removed_at":
        fresh = F.lit(None).cast("timestamp")
    else:
        fresh = F.col(f"s.{name}")
    return F.when(is_new, fresh).otherwise(kept).alias(name)


def row_outcomes(target: DataFrame, entities: DataFrame, *, on_conflict: str = DO_UPDATE) -> DataFrame:
    """Outcome of every incoming row: the first row of a new key is inserted, all others are not.

    The first rows are found by an aggregate and matched on the key *and* ``_pos``, so the rows of a
    crowded key are spread over all tasks.
    """
    firsts = entities.groupBy(*KEY).agg(F.min(given_pos()).alias("_pos"))
    inserted = firsts.join(target.select(*KEY), KEY, "left_anti").withColumn("_new", F.lit(True))
    return entities.join(inserted, [*KEY, "_pos"], "left").withColumn(
        "outcome",
        F.when(F.col("_new"), INSERTED).otherwise(SKIPPED if on_conflict == DO_NOTHING else UPDATED),
    ).drop("_new")


def soft_delete_entities(
    target: DataFrame, keys: DataFrame, now: Column, *, enabled: bool = True
) -> tuple[DataFrame, DataFrame]:
    """New target with ``removed_at`` set on live rows whose key is in ``keys``, and the changed keys."""
    if not enabled:
        raise ValueError("this table has no soft-delete column")
    wanted = keys.select(*KEY).where("source is not null and source_id is not null").distinct()
    marked = target.join(wanted.withColumn("_hit", F.lit(True)), KEY, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & F.col("removed_at").isNull()
    changed = marked.where(hit).select(*KEY)
    updated = marked.withColumn(
        "removed_at", F.when(hit, now.cast("timestamp")).otherwise(F.col("removed_at"))
    )
    return updated.select(*ENTITY_TABLE.fieldNames()), changed


def dry_run(entities: DataFrame) -> DataFrame:
    """Nothing is written; every row counts as inserted."""
    return entities.withColumn("outcome", F.lit(INSERTED))
