"""Reports over a landed fetch log: chosen responses, status counts, pacing, mirror health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoingest.operators.pacing import RUN_SCHEMA, fold_sorted
from geoingest.session import broadcast_if_small

# Statuses that slow a source down, pacing limits in seconds, mirror cool-downs.
BACKOFF_STATUSES = (429, 500, 502, 503, 504)
MAX_INTERVAL_S = 60.0
RELAX_AFTER_S = 30.0
MAX_RETRIES = 2
COOLDOWN_S = 60.0
#: Mirrors whose aggregate may be broadcast to the log.
MAX_BROADCAST_MIRRORS = 10_000


def is_success(status: Column) -> Column:
    return F.coalesce((status >= 200) & (status < 400), F.lit(False))


def select_response(
    log: DataFrame, *, key: str = "url", max_retries: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """First successful attempt per url, and the urls without one; each url is in exactly one of them.

    All logged attempts count, unless ``max_retries`` limits them; a url that succeeded beyond the limit only is
    exhausted. Attempts are ordered by number, strategy and time; further ties by a digest of the row. The
    winner is found over narrow columns by an aggregate that combines on the map side; only successful
    rows are then joined with it for their bodies.
    """
    rest = [c for c in log.columns if c != key]
    plain = [name for name, kind in log.dtypes if "map<" not in kind and "variant" not in kind]
    tie = F.xxhash64(*plain) if "ts" not in rest else F.lit(0).cast("long")
    order = F.struct("attempt", "strategy_rank", *(["ts"] if "ts" in rest else []), tie.alias("_tie"))
    within = F.lit(True) if max_retries is None else F.coalesce(F.col("attempt") <= max_retries + 1, F.lit(False))
    won = is_success(F.col("status")) & within
    log = log.where(F.col(key).isNotNull())
    best = log.groupBy(key).agg(F.min(F.when(won, order)).alias("_best"))
    rows = log.where(won).join(best.where("_best is not null"), key).where(order == F.col("_best"))
    chosen = rows.select(*log.columns).dropDuplicates([key]).select(key, *rest)
    exhausted = best.where("_best is null").select(
        key,
        F.lit("fetch").alias("stage"),
        F.concat(F.lit("fetch: RuntimeError: all strategies exhausted for "), F.col(key)).alias("detail"),
    )
    return chosen, exhausted


def status_counts(log: DataFrame, *, group: str = "source") -> DataFrame:
    return log.groupBy(group, "status").agg(F.count("*").alias("n"))


def status_count_map(log: DataFrame, *, group: str = "source") -> DataFrame:
    """Counts per status as one map per source, statuses ascending; as many entries as statuses."""
    entries = F.array_sort(F.collect_list(F.struct("status", "n")))
    as_map = F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["status"].cast("string"), e["n"]))
    )
    return (
        status_counts(log, group=group)
        .where("status is not null")
        .groupBy(group)
        .agg(as_map.alias("by_status"))
    )


def backoff_interval(
    log: DataFrame,
    *,
    base_interval: float = 0.5,
    group: str = "source",
    tie: str | None = None,
    start_ts: Column | None = None,
) -> DataFrame:
    """Pacing interval per source after all its events in time order (see :func:`pacing_state`)."""
    state = pacing_state(log, base_interval=base_interval, group=group, tie=tie, start_ts=start_ts)
    return state.select(group, "current_interval_s")


def pacing_state(
    log: DataFrame,
    known: DataFrame | None = None,
    *,
    base_interval: float = 0.5,
    group: str = "source",
    tie: str | None = None,
    start_ts: Column | None = None,
) -> DataFrame:
    """Pacing interval and time of the last answer per source (``current_interval_s``, ``last_ok_us``).

    The log is range-partitioned by (source, time, tie), which cuts a source of any size into even
    runs; each is folded where it lies and only the runs, at most one per partition, are chained per
    source. The relax clock starts at ``start_ts``, by default at the first event of the source. ``known``
    is the state before the log, as this function returns it; sources without new events keep theirs.
    """
    if not 0 < base_interval <= MAX_INTERVAL_S:
        raise ValueError("base_interval must lie between 0 and 60 seconds")
    relax_us = int(RELAX_AFTER_S * 1e6)
    slow = F.coalesce(F.col("status").isin(*BACKOFF_STATUSES), F.lit(False))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    # Without a tie of its own, events of one time and source are taken by status.
    order = [group, "_us", "_tie", "_status"]
    events = log.where(f"{group} is not null and ts is not null").select(
        F.col(group).cast("string").alias(group),
        micros.alias("_us"),
        slow.alias("_slow"),
        (F.col(tie) if tie else F.lit(0)).alias("_tie"),
        F.col("status").alias("_status"),
    )
    runs = (
        events.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(fold_sorted(group, base_interval, MAX_INTERVAL_S, relax_us), f"{group} string, {RUN_SCHEMA}")
    )

    def clamp(x: Column, part: Column, name: str) -> Column:
        return F.least(F.greatest(part[name] * x, part[f"{name}_lo"]), part[f"{name}_hi"])

    def step(acc: Column, r: Column) -> Column:
        slowed = clamp(acc["x"], r, "head")
        relaxed = F.when(
            r["ok_us"] - acc["last_ok"] > relax_us, F.greatest(F.lit(base_interval), slowed / 2)
        ).otherwise(slowed)
        return F.when(
            r["ok_us"].isNull(), F.struct(slowed.alias("x"), acc["last_ok"].alias("last_ok"))
        ).otherwise(F.struct(clamp(relaxed, r, "tail").alias("x"), r["last_ok_us"].alias("last_ok")))

    # Partitions follow each other in the order of the log, also where runs begin at the same time.
    names = ["_part", *[f.split()[0] for f in RUN_SCHEMA.split(", ")]]
    runs = runs.withColumn("_part", F.spark_partition_id())
    per_source = runs.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*names))).alias("_runs"))
    first = F.get("_runs", F.lit(0))["first_us"]
    start = first if start_ts is None else F.unix_micros(start_ts.cast("timestamp"))
    x, last_ok = F.lit(float(base_interval)), start.cast("long")
    if known is not None:
        per_source = per_source.join(known.select(group, "current_interval_s", "last_ok_us"), group, "full_outer")
        x, last_ok = F.coalesce("current_interval_s", x), F.coalesce("last_ok_us", last_ok)
    zero = F.struct(x.alias("x"), last_ok.alias("last_ok"))
    told = F.when(F.col("_runs").isNull(), zero).otherwise(F.aggregate("_runs", zero, step))
    told = per_source.select(group, told.alias("_told"))
    return told.select(group, F.col("_told.x").alias("current_interval_s"), F.col("_told.last_ok").alias("last_ok_us"))


def rate_stats(
    log: DataFrame,
    *,
    rate_per_sec: float = 2.0,
    burst: int = 4,
    group: str = "source",
    tie: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Status counts next to the pacing state of each source, stamped with ``now`` when it is given."""
    stamp = [] if now is None else [F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts")]
    pace = backoff_interval(log, base_interval=1.0 / rate_per_sec, group=group, tie=tie)
    return (
        status_count_map(log, group=group)
        .join(pace, group, "full_outer")
        .select(
            group,
            F.lit(float(rate_per_sec)).alias("rate_per_sec"),
            F.lit(burst).alias("burst"),
            F.round("current_interval_s", 4).alias("current_interval_s"),
            (F.col("current_interval_s") > (1.0 / rate_per_sec) * 1.05).alias("backoff_active"),
            "by_status",
            *stamp,
        )
    )


def cooldown_seconds(status: Column) -> Column:
    """Cool-down a mirror outcome sets; null leaves it as it was. Status null or 0 is a failed request."""
    return (
        F.when(status.isNull() | (status == 0), COOLDOWN_S)
        .when(status.between(200, 299), 0.0)
        .when(status == 406, COOLDOWN_S * 2)
        .when(status >= 500, COOLDOWN_S)
    )


def mirror_health(log: DataFrame, now: Column, *, mirror: str = "mirror", tie: str = "event_id") -> DataFrame:
    """Last status, times, failures since the last success and remaining cool-down per mirror (see :func:`mirror_state`)."""
    return health_at(mirror_state(log, mirror=mirror, tie=tie), now, mirror=mirror)


def health_at(state: DataFrame, now: Column, *, mirror: str = "mirror") -> DataFrame:
    """What the state of the mirrors says at a time: the cool-down that remains."""
    now_s = F.unix_micros(now.cast("timestamp")) / 1e6
    return state.select(
        mirror,
        F.coalesce("last_status", F.lit(0)).alias("last_status"),
        "last_success_ts",
        "last_attempt_ts",
        "consecutive_failures",
        F.round(F.greatest(F.lit(0.0), F.coalesce("cooling_until_s", F.lit(0.0)) - now_s), 1).alias("cooldown_remaining_s"),
    )


def mirror_state(log: DataFrame, known: DataFrame | None = None, *, mirror: str = "mirror", tie: str = "event_id") -> DataFrame:
    """Last status, times, failures since the last success and end of the cool-down per mirror.

    A request that failed without a response adds a failure and a cool-down only. The aggregate, one row per
    mirror, joins back to the log for the failure count: by broadcast up to ``MAX_BROADCAST_MIRRORS`` of them.
    ``known`` is the state before the log, as this function returns it; mirrors without new events keep theirs.
    """
    status = F.col("status")
    order = F.struct("ts", tie)
    answered = status.isNotNull() & (status != 0)
    success = status.between(200, 299)
    cooldown = cooldown_seconds(status)
    ts_s = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    events = log.select(mirror, "ts", tie, "status")
    health = events.groupBy(mirror).agg(
        F.max_by(F.when(answered, status), F.when(answered, order)).alias("last_status"),
        F.max(F.when(success, F.col("ts"))).alias("last_success_ts"),
        F.max(F.when(answered, F.col("ts"))).alias("last_attempt_ts"),
        F.max(F.when(success, order)).alias("_last_ok"),
        F.max_by(
            F.when(cooldown.isNotNull(), F.when(cooldown > 0, ts_s + cooldown).otherwise(0.0)),
            F.when(cooldown.isNotNull(), order),
        ).alias("_until"),
    )
    since = (
        events.join(broadcast_if_small(health.select(mirror, "_last_ok"), MAX_BROADCAST_MIRRORS), mirror)
        .where(F.col("_last_ok").isNull() | (order > F.col("_last_ok")))
        .groupBy(mirror)
        .agg(F.count("*").alias("consecutive_failures"))
    )
    state = health.join(since, mirror, "left").select(
        mirror,
        "last_status",
        "last_success_ts",
        "last_attempt_ts",
        F.coalesce("consecutive_failures", F.lit(0)).cast("bigint").alias("consecutive_failures"),
        F.col("_until").alias("cooling_until_s"),
        F.col("_last_ok").isNotNull().alias("_won"),
    )
    if known is None:
        return state.drop("_won")
    new, old = state.alias("n"), known.alias("k")
    failures = F.coalesce("n.consecutive_failures", F.lit(0)) + F.when(
        F.coalesce("n._won", F.lit(False)), F.lit(0)
    ).otherwise(F.coalesce("k.consecutive_failures", F.lit(0)))
    both = new.join(old, F.col(f"n.{mirror}") == F.col(f"k.{mirror}"), "full_outer")
    return both.select(
        *[
            (failures if c == "consecutive_failures" else (F.greatest if c.endswith("_ts") else F.coalesce)(f"n.{c}", f"k.{c}")).alias(c)
            for c in state.columns if c != "_won"
        ]
    )


def rank_mirrors(health: DataFrame, mirrors: Sequence[str], *, mirror: str = "mirror") -> DataFrame:
    """Candidates in the order they should be tried; rank 1 is the pick.

    Only the configured ``mirrors`` take part, so the ranking window holds at most that many rows.
    Cooling mirrors are left out unless all of them cool, then all are candidates.
    """
    config = F.create_map(*[F.lit(x) for i, m in enumerate(mirrors) for x in (m, i)])
    known = health.where(F.col(mirror).isin(*mirrors)).withColumn("config_rank", config[F.col(mirror)])
    # A configured mirror without any log row has never been tried, so it is usable.
    listed = health.sparkSession.createDataFrame(
        [(m, i) for i, m in enumerate(mirrors)], f"{mirror} string, config_rank int"
    )
    known = listed.join(known.drop("config_rank"), mirror, "left").withColumn(
        "usable", F.coalesce(F.col("cooldown_remaining_s") <= 0, F.lit(True))
    )
    everyone = W.partitionBy()
    candidates = known.withColumn("_any", F.max("usable").over(everyone)).where("usable or not _any")
    order = W.orderBy(F.col("last_success_ts").desc_nulls_last(), "config_rank")
    return candidates.select(mirror, "config_rank", "usable", F.row_number().over(order).alias("rank"))


def windowed_health(log: DataFrame, *, group: str = "source", width: str = "7 days", slide: str = "1 day", late: str | None = None) -> DataFrame:
    """Attempts, failures and slow-downs per source and sliding window of event time.

    The same aggregate over a table and over a stream; ``late`` is the stream's watermark, after which windows are dropped from state.
    """
    log = log.where(F.col("ts").isNotNull()).withColumn("ts", F.col("ts").cast("timestamp"))
    seen = log.withWatermark("ts", late) if late else log
    won = is_success(F.col("status"))
    counts = seen.groupBy(group, F.window("ts", width, slide)).agg(
        F.count("*").alias("attempts"),
        F.sum((~won).cast("long")).alias("failures"),
        F.sum(F.coalesce(F.col("status").isin(*BACKOFF_STATUSES), F.lit(False)).cast("long")).alias("slowed"),
        F.max("ts").alias("last_ts"),
    )
    return counts.select(group, F.col("window.start").alias("since"), F.col("window.end").alias("until"), "attempts", "failures", "slowed", "last_ts")


def outages(log: DataFrame, *, group: str = "source", gap: str = "1 hour", late: str | None = None) -> DataFrame:
    """Runs of failed attempts of a source that follow each other within ``gap``: start, last failure and number.

    Sessions of event time, over a table or, with the watermark ``late``, over a stream.
    """
    failed = log.where(F.col("ts").isNotNull() & ~is_success(F.col("status"))).withColumn("ts", F.col("ts").cast("timestamp"))
    failed = failed.withWatermark("ts", late) if late else failed
    runs = failed.groupBy(group, F.session_window("ts", gap)).agg(F.count("*").alias("failures"), F.max("ts").alias("last_ts"))
    return runs.select(group, F.col("session_window.start").alias("first_ts"), "last_ts", "failures")
