"""One run: read, normalize, enrich, persist, record failures, log."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from geoingest.functions.text import error_text, persist_error
from geoingest.operators.enrich import enrich
from geoingest.operators.failures import record_failures
from geoingest.operators.fetchlog import select_response
from geoingest.operators.merge import DO_UPDATE, invalid_reason, upsert_entities
from geoingest.operators.normalize import NORMALIZER_NONE, normalize
from geoingest.schemas import RUN_LOG
from geoingest.session import checkpoint_dir
from geoingest.sinks.buckets import BucketTable
from geoingest.sinks.tables import VersionedTable, append_run_log, write_per_run
from geoingest.sources.record import NO_RECORD

Stage = Callable[[DataFrame], DataFrame]

log = logging.getLogger(__name__)


@dataclass
class Target:
    """A sink of entities. Without a table it is a dry run: every row counts as inserted.

    ``write`` takes any other sink: a function of the valid rows and ``now`` that stores them and returns what
    became of each key, ``(n_inserted, n_updated, n_skipped)``, as ``upsert_entities`` does.
    """

    table: VersionedTable | BucketTable | None = None
    name: str = "entities"
    on_conflict: str = DO_UPDATE
    soft_delete: bool = True
    write: Callable[[DataFrame, Column], DataFrame] | None = None


@dataclass
class RunResult:
    rows_total: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_skipped: int = 0
    rows_failed: int = 0
    duration_ms: int = 0
    errors: list[str] = field(default_factory=list)
    #: Rows that an enricher failed on and left as they were, summed over the enrichers.
    rows_unenriched: int = 0


#: Rows that a task takes apart and sorts for a merge; each becomes a row per attribute, some 1 KB in all.
ROWS_PER_TASK = 200_000

_STAGED = [
    "entity_type", "source", "source_id", "geom", "attrs", "bbox_country", "confidence", "_pos",
    "text", "raw_ref", "coord_hint", "_stage", "_outcome", "_error", "_enrich_error",
]


def run_ingest(
    spark: SparkSession,
    locators: DataFrame,
    reader: Stage,
    *,
    source_name: str,
    now: Column,
    normalizer: Stage | None = None,
    enrichers: Sequence[Stage] = (),
    targets: Sequence[Target] = (Target(name="dryrun"),),
    failures: VersionedTable | BucketTable | None = None,
    run_log_path: str | None = None,
    http_status: int | None = None,
    run_id: str | None = None,
    tag: str | None = None,
    errors_kept: int = 3,
    errors_path: str | None = None,
) -> RunResult:
    """Read ``locators(value, _pos)`` with ``reader`` and carry the records to all targets.

    ``reader`` returns raw records; a reader called with ``keep_failed=True`` also tells which locators
    gave none, otherwise they are found by an anti join on ``_pos``. The rows of the run are computed
    once and written to a table in the checkpoint folder, which the merges, the failure table and the
    counters read column by column; so are the locators, before anything reads them, and what the reader
    gave. All of them go when the run ends, also when it fails. A locator that gave a record but no row, since a normalizer or
    enricher dropped it, counts as skipped. ``errors_path`` takes the errors of all rows, of which the
    result holds the first. A ``tag`` makes the run repeatable: a table that holds it already is left alone.
    The rows are counted while they are written. The run log and the errors keep a folder per run, which a run with
    the same ``run_id`` replaces, so neither a repeated run nor a write that dies leaves rows twice.
    """
    run_id = run_id or uuid4().hex
    base = f"{checkpoint_dir(spark)}/run-{run_id}-{uuid4().hex[:8]}"
    try:
        return _run(
            spark, locators, reader, base, source_name=source_name, now=now, normalizer=normalizer, enrichers=enrichers,
            targets=targets, failures=failures, run_log_path=run_log_path, http_status=http_status, run_id=run_id,
            tag=tag, errors_kept=errors_kept, errors_path=errors_path,
        )
    finally:
        _delete(spark, base)


def _place_sums(when: Column) -> dict[str, Column]:
    """Sums over two hashes of ``_pos``, in pieces of 21 bits, which no number of rows overflows.

    Two sets of rows with equal sums have the same places, each as often.
    """
    pos = F.col("_pos").cast("long")
    hashes = [F.xxhash64(pos), F.xxhash64(pos, F.lit(1))]
    pieces = [F.shiftrightunsigned(h, 21 * i).bitwiseAND(F.lit((1 << 21) - 1)) for h in hashes for i in range(3)]
    return {f"place_{i}": F.coalesce(F.sum(F.when(when, p)), F.lit(0)) for i, p in enumerate(pieces)}


def _places(*counts: dict[str, int]) -> list[int]:
    return [sum(c[f"place_{i}"] for c in counts) for i in range(6)]


def _write_counted(df: DataFrame, path: str) -> dict[str, int]:
    """Write shaped rows and count them by what became of them in the same pass."""
    open_ = F.col("_outcome").isNull()
    told = Observation(f"rows-{uuid4().hex}")
    counts = {
        "n": F.lit(True),
        "n_good": F.col("_stage") == "normalize",
        "n_valid": open_ & F.col("_reason").isNull(),
        "n_refused": open_ & F.col("_reason").isNotNull(),
        "n_skipped": F.col("_outcome") == "skipped",
        "n_failed": F.col("_outcome") == "failed",
        "n_apart": F.col("_enrich_error").isNotNull(),
        "n_unnamed": F.col("source_id").isNull(),
    }
    sums = {k: F.count(F.when(c, 1)) for k, c in counts.items()} | _place_sums(F.lit(True))
    df.observe(told, *[c.alias(k) for k, c in sums.items()]).write.mode("overwrite").parquet(path)
    return told.get


def _fetched(df: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Stage what the reader gave, so that it runs once for records and failed locators; also counts of the latter."""
    told, failed = Observation(f"fetched-{uuid4().hex}"), F.col("_fetch_error").isNotNull()
    counts = {"n": F.count(F.when(failed, 1)), "n_unnamed": F.count(F.when(failed & F.col("_locator").isNull(), 1))}
    kept = _kept(df.observe(told, *[c.alias(k) for k, c in (counts | _place_sums(failed)).items()]), path)
    return kept, told.get


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows over so many tasks that none sorts more than ``ROWS_PER_TASK`` of them, however many a split holds."""
    splits = rows._jdf.queryExecution().toRdd().getNumPartitions()
    return rows.repartition(-(-n // ROWS_PER_TASK), "_pos") if n > splits * ROWS_PER_TASK else rows


def _stage_rows(good: DataFrame, enrichers: Sequence[Stage], shaped: Stage, base: str) -> dict[str, int]:
    """Write the rows; returns their counts and, as ``n_left``, how many an enricher left as they were because it failed on them."""
    try:
        df, unplanned = good, 0
        for fn in enrichers:
            if _planned(fn, df) is None:
                unplanned += 1
            else:
                df = enrich(df, [fn])
        counts = _write_counted(shaped(df), f"{base}/rows")
        return counts | {"n_left": unplanned * counts["n_good"]}
    except PySparkException:
        if not enrichers:
            raise
    at, left = _kept(good, f"{base}/normalized"), 0
    for i, fn in enumerate(enrichers):
        at, n = _enriched_apart(at, fn, f"{base}/enriched-{i}")
        left += n
        if n:
            log.warning("enricher %s left %d rows as they were", getattr(fn, "__name__", fn), n)
    return _write_counted(shaped(at), f"{base}/rows") | {"n_left": left}


def _planned(fn: Stage, df: DataFrame) -> DataFrame | None:
    try:
        out = fn(df)
        out.schema  # a plan that does not resolve fails here
        return out
    except Exception as exc:  # noqa: BLE001
        log.warning("enricher %s left out: %s", getattr(fn, "__name__", fn), exc)
        return None


def _storable(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) if kind == "void" else F.col(f"`{c}`") for c, kind in df.dtypes])


def _kept(df: DataFrame, path: str) -> DataFrame:
    df = _storable(df)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _enriched_apart(rows: DataFrame, fn: Stage, path: str) -> tuple[DataFrame, int]:
    """Enrich staged rows; those that ``fn`` fails on, found by halving what fails, stay as they were.

    Each failing split is staged as two halves, so one bad row costs about two readings of the rows in all.
    """
    spark, planned = rows.sparkSession, _planned(fn, rows)
    if planned is None:
        return rows, rows.count()
    schema, left = _storable(planned).schema, 0

    def store(df: DataFrame) -> None:
        values = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        df.select(*values).write.mode("append").parquet(f"{path}/out")

    todo = [(_kept(rows.withColumn("_gx_row", F.monotonically_increasing_id()), f"{path}/all"), 0, f"{path}/all")]
    while todo:
        part, depth, where = todo.pop()
        plain = part.drop("_gx_row")
        try:
            store(fn(plain))
        except PySparkException as exc:
            n = part.count()
            if n <= 1:
                log.warning("enricher %s fails on a row: %s", getattr(fn, "__name__", fn), str(exc)[:300])
                store(plain)
                left += n
                continue
            # The hash of one long is one to one: its bits tell all rows apart.
            bit = F.shiftrightunsigned(F.xxhash64("_gx_row"), depth).bitwiseAND(F.lit(1))
            for side in (0, 1):
                half = f"{where}-{side}"
                todo.append((_kept(part.where(bit == side), half), depth + 1, half))
            _delete(spark, where)
    return spark.read.schema(schema).parquet(f"{path}/out"), left


def _run(
    spark: SparkSession,
    locators: DataFrame,
    reader: Stage,
    base: str,
    *,
    source_name: str,
    now: Column,
    normalizer: Stage | None,
    enrichers: Sequence[Stage],
    targets: Sequence[Target],
    failures: VersionedTable | BucketTable | None,
    run_log_path: str | None,
    http_status: int | None,
    run_id: str,
    tag: str | None,
    errors_kept: int,
    errors_path: str | None,
) -> RunResult:
    started = time.monotonic()
    # Whole numbers only: other places are compared as a join does.
    whole = locators.schema["_pos"].dataType.typeName() in ("byte", "short", "integer", "long")
    listed = Observation(f"locators-{uuid4().hex}")
    sums = {"n_unplaced": F.count(F.when(F.col("_pos").isNull(), 1))} | (_place_sums(F.lit(True)) if whole else {})
    locators.observe(listed, *[c.alias(k) for k, c in sums.items()]).write.mode("overwrite").parquet(f"{base}/locators")
    located = spark.read.schema(locators.schema).parquet(f"{base}/locators")
    raw = reader(located)
    if "_error" not in raw.columns:
        raw = _with_missing(located, raw)
    fetched, n_missing = _fetched(raw.withColumnRenamed("_error", "_fetch_error"), f"{base}/fetched")
    missing = fetched.where("_fetch_error is not null").select(
        F.lit(source_name).alias("source"),
        F.col("_locator").alias("source_id"),
        F.lit("").alias("raw_ref"),
        "_pos",
        F.lit("fetch").alias("_stage"),
        F.lit("skipped").alias("_outcome"),
        F.col("_fetch_error").alias("_error"),
    )

    def shaped(good: DataFrame) -> DataFrame:
        if "_enrich_error" not in good.columns:
            good = good.withColumn("_enrich_error", F.lit(None).cast("string"))
        # The missing rows are read where they are staged; here they only lend their columns.
        both = good.withColumn("_stage", F.lit("normalize")).unionByName(missing.where(F.lit(False)), allowMissingColumns=True)
        return both.select(*_STAGED).withColumn("_reason", F.when(F.col("_outcome").isNull(), invalid_reason()))

    counts = _stage_rows(normalize(fetched.where("_fetch_error is null"), normalizer), enrichers, shaped, base)
    rows = spark.read.parquet(f"{base}/rows").unionByName(missing, allowMissingColumns=True)
    dropped = located.join(rows.select("_pos"), "_pos", "left_anti").select(
        F.lit(source_name).alias("source"), F.col("value").alias("source_id"), F.lit("").alias("raw_ref"), "_pos",
        F.lit("normalize").alias("_stage"), F.lit("skipped").alias("_outcome"), F.lit(NORMALIZER_NONE).alias("_error"),
    )
    n_dropped = {"n": 0, "n_unnamed": 0}
    if not whole or listed.get["n_unplaced"] or _places(listed.get) != _places(counts, n_missing):
        lost = Observation(f"dropped-{uuid4().hex}")
        unnamed = F.count(F.when(F.col("source_id").isNull(), 1))
        dropped.observe(lost, F.count(F.lit(1)).alias("n"), unnamed.alias("n_unnamed")).write.mode("overwrite").parquet(f"{base}/dropped")
        rows = rows.unionByName(spark.read.schema(dropped.schema).parquet(f"{base}/dropped"), allowMissingColumns=True)
        n_dropped = lost.get

    result = RunResult(rows_unenriched=counts["n_left"] + counts["n_apart"], rows_failed=counts["n_failed"])
    result.rows_total = counts["n"] + n_missing["n"] + n_dropped["n"]
    result.rows_skipped = counts["n_skipped"] + n_missing["n"] + n_dropped["n"]
    n_refused, n_valid = counts["n_refused"], counts["n_valid"]

    valid = _dealt(rows.where("_outcome is null and _reason is null"), n_valid)
    refused = rows.where("_outcome is null and _reason is not null")
    events = [rows.where("_outcome is not null").withColumn("_seq", F.lit(0))]
    for i, target in enumerate(targets):
        if target.write is not None:
            sums = target.write(valid, now).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_inserted", "n_updated", "n_skipped")])
            told = sums.first()
            result.rows_inserted += told["n_inserted"]
            result.rows_updated += told["n_updated"]
            result.rows_skipped += told["n_skipped"]
            added = None
        elif target.table is None:
            result.rows_inserted += n_valid + n_refused
            continue
        else:
            added = _persist(target, valid, now, tag)
            result.rows_inserted += added
        if added is None:
            pass
        elif target.on_conflict == DO_UPDATE:
            result.rows_updated += n_valid - added
        else:
            result.rows_skipped += n_valid - added
        result.rows_failed += n_refused
        events.append(
            refused.withColumn(
                "_error", persist_error(target.name, F.lit("NotPersisted"), F.col("_reason"))
            )
            .withColumn("_stage", F.lit("persist"))
            .withColumn("_seq", F.lit(i + 1))
        )
    failed = events[0]
    for more in events[1:]:
        failed = failed.unionByName(more, allowMissingColumns=True)
    if result.rows_skipped + counts["n_failed"] + n_refused:
        # A bounded sample by design: the first errors of the run, for the summary and the log row.
        first = failed.select("_pos", "_seq", "_error").orderBy("_pos", "_seq").limit(max(errors_kept, 1)).collect()
        result.errors = [r["_error"] for r in first]
    # A row without a key of its own is recorded under the locator it came from; without such rows nothing is joined.
    told = failed.where("source_id is not null").withColumn("_value", F.lit(None).cast(located.schema["value"].dataType))
    if counts["n_unnamed"] + n_missing["n_unnamed"] + n_dropped["n_unnamed"]:
        values = located.select("_pos", F.col("value").alias("_value")).dropDuplicates(["_pos"])
        told = told.unionByName(failed.where("source_id is null").join(values, "_pos", "left"))
    failed = told.withColumn("source", F.coalesce("source", F.lit(source_name)))
    failed = failed.withColumn("source_id", F.coalesce("source_id", F.col("_value").cast("string")))
    failed = failed.select(
        "source", "source_id", "text", "raw_ref", "coord_hint",
        F.col("_stage").alias("stage"), F.col("_error").alias("detail"),
        F.struct("_pos", "_seq").alias("_pos"),
    )
    if errors_path is not None and not (tag and _logged(spark, errors_path, run_id)):
        told = failed.select(F.lit(run_id).alias("run_id"), "source", "source_id", "stage", "detail", "_pos._pos")
        write_per_run(told, errors_path)
    if isinstance(failures, BucketTable):
        failures.record_failures(failed, now, tag=tag)
    elif failures is not None and not (tag and failures.has(tag)):
        failures.commit(record_failures(failures.read(), failed, now), tag)
    result.duration_ms = int((time.monotonic() - started) * 1000)
    if run_log_path is not None and not (tag and _logged(spark, run_log_path, run_id)):
        _log_run(spark, result, run_log_path, run_id, now, source_name, http_status)
    return result


def fetch_error(df: DataFrame, message: Column) -> DataFrame:
    """Mark rows whose fetch failed with the text a run reports."""
    return df.withColumn("_error", error_text("fetch", F.lit("RuntimeError"), message))


def landed_reader(log: DataFrame, parse: Callable[..., DataFrame], **options) -> Stage:
    """Reader of locators whose responses are in a fetch log.

    ``parse`` is a source such as ``html_records`` or ``json_records``. The first successful attempt of
    each locator is parsed; a locator without one is a fetch failure.
    """
    chosen, _ = select_response(log)
    responses = chosen.withColumnRenamed("url", "value").withColumn("_landed", F.lit(True))

    def reader(locators: DataFrame) -> DataFrame:
        rows = locators.select("value", "_pos").join(responses, "value", "left")
        message = F.concat(F.lit("all strategies exhausted for "), F.col("value"))
        lost = error_text("fetch", F.lit("RuntimeError"), message)
        rows = rows.withColumn("_not_landed", F.when(F.col("_landed").isNull(), lost)).drop("_landed")
        return parse(rows, url="value", keep_failed=True, **options)

    return reader


def _with_missing(locators: DataFrame, raw: DataFrame) -> DataFrame:
    missing = locators.join(raw.select("_pos"), "_pos", "left_anti").select(
        "_pos", F.col("value").alias("_locator"), F.lit(NO_RECORD).alias("_error")
    )
    known = raw.withColumn("_error", F.lit(None).cast("string"))
    return known.unionByName(missing, allowMissingColumns=True)


def _persist(target: Target, valid: DataFrame, now: Column, tag: str | None) -> int:
    """Upsert and return the number of new keys; an upsert never deletes, so the row counts tell."""
    table = target.table
    if isinstance(table, BucketTable):
        # A replayed batch finds its buckets written; what it added to them was told by the run before.
        return table.upsert(valid, now, on_conflict=target.on_conflict, soft_delete=target.soft_delete, tag=tag)["n_inserted"]
    if tag and table.has(tag):
        if not table.has_version(tag):
            return 0  # pruned since: the batch is stored, what it added is no longer known
        versions = table.read_before(tag).count(), table.read_tagged(tag).count()
        return versions[1] - versions[0]
    before = table.read()
    merged, _ = upsert_entities(
        before, valid, now, on_conflict=target.on_conflict, soft_delete=target.soft_delete
    )
    stored = Observation(f"stored-{uuid4().hex}")
    table.commit(merged.observe(stored, F.count(F.lit(1)).alias("n")), tag)
    return stored.get["n"] - before.count()


def _logged(spark: SparkSession, path: str, run_id: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return False
    told = spark.read.schema("run_id string").option("recursiveFileLookup", "true").parquet(path)
    return not told.where(F.col("run_id") == run_id).isEmpty()


def _log_run(
    spark: SparkSession, result: RunResult, path: str, run_id: str, now: Column, source: str, status: int | None
) -> None:
    row = (
        run_id, None, source, result.rows_inserted, result.rows_updated, status,
        result.errors[0] if result.errors else None, result.duration_ms,
    )
    log = spark.createDataFrame([row], RUN_LOG).withColumn("run_ts", now.cast("timestamp"))
    append_run_log(log, path)


def _delete(spark: SparkSession, location: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
