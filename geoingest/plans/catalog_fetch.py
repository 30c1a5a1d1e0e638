"""Registered queries: fetch log, pacing, mirrors, accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.operators import accounts, fetchlog
from geoingest.plans.derived import FETCH_SQL, fetch_log
from geoingest.plans.registry import query, table

MIRRORS = ["m2", "m0", "m1", "m9"]


def _text_ts(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


_WON = """won AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY attempt, strategy_rank, ts) AS rn
  FROM fetchlog WHERE status >= 200 AND status < 400)"""


@query(f"WITH {FETCH_SQL}, {_WON} SELECT url, event_id, attempt, strategy, status FROM won WHERE rn = 1")
def select_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First successful attempt of every url."""
    chosen, _ = fetchlog.select_response(fetch_log(spark, sf_dir))
    return chosen.select("url", "event_id", "attempt", "strategy", "status")


@query(f"""WITH {FETCH_SQL} SELECT url, 'fetch' AS stage,
  concat('fetch: RuntimeError: all strategies exhausted for ', url) AS detail
FROM fetchlog GROUP BY url HAVING count(*) FILTER (WHERE status >= 200 AND status < 400) = 0""")
def exhausted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls no attempt succeeded for."""
    _, exhausted = fetchlog.select_response(fetch_log(spark, sf_dir))
    return exhausted


@query(f"WITH {FETCH_SQL} SELECT source, status, CAST(count(*) AS BIGINT) AS n FROM fetchlog GROUP BY source, status")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetchlog.status_counts(fetch_log(spark, sf_dir))


# The fold is sequential: one recursion step per event of a source.
_PACE = """ev AS (SELECT source, status, epoch_us(ts) AS us, row_number() OVER (PARTITION BY source ORDER BY ts, event_id) AS rn FROM fetchlog),
fold(source, rn, x, last_ok) AS (
  SELECT source, CAST(0 AS BIGINT), CAST({base} AS DOUBLE), min(us) FROM ev GROUP BY source
  UNION ALL
  SELECT f.source, e.rn,
    CASE WHEN e.status IN (429, 500, 502, 503, 504) THEN least(60.0, 2 * f.x)
         WHEN e.us - f.last_ok > 30000000 THEN greatest({base}, f.x / 2) ELSE f.x END,
    CASE WHEN e.status IN (429, 500, 502, 503, 504) THEN f.last_ok ELSE e.us END
  FROM fold f JOIN ev e ON e.source = f.source AND e.rn = f.rn + 1
), pace AS (SELECT source, arg_max(x, rn) AS x FROM fold GROUP BY source)"""


_DAY = "CAST(CAST(ts AS DATE) AS TIMESTAMP)"


@query(f"""WITH RECURSIVE {FETCH_SQL}, {_PACE.format(base='0.5').replace('epoch_us(ts)', f'epoch_us({_DAY})').replace('ORDER BY ts,', f'ORDER BY {_DAY},')}
SELECT source, round(x, 6) AS current_interval_s FROM pace""")
def backoff_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a log with day stamps: events of one day follow each other by their id."""
    log = fetch_log(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    out = fetchlog.backoff_interval(log, base_interval=0.5, tie="event_id")
    return out.select("source", F.round("current_interval_s", 6).alias("current_interval_s"))


@query(f"WITH RECURSIVE {FETCH_SQL}, {_PACE.format(base='0.7')} SELECT source, round(x, 6) AS current_interval_s FROM pace")
def backoff_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pacing interval of every source after its whole log."""
    out = fetchlog.backoff_interval(fetch_log(spark, sf_dir), base_interval=0.7, tie="event_id")
    return out.select("source", F.round("current_interval_s", 6).alias("current_interval_s"))


@query(f"""WITH RECURSIVE {FETCH_SQL}, {_PACE.format(base='0.5')},
counts AS (SELECT source, status, count(*) AS n FROM fetchlog GROUP BY source, status)
SELECT source, CAST(2 AS DOUBLE) AS rate_per_sec, 4 AS burst, round(x, 4) AS current_interval_s, x > 0.525 AS backoff_active,
  (SELECT string_agg(concat(CAST(status AS STRING), '=', CAST(n AS STRING)), '|' ORDER BY status) FROM counts c WHERE c.source = pace.source) AS by_status
FROM pace""")
def rate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts and pacing state of every source."""
    stats = fetchlog.rate_stats(fetch_log(spark, sf_dir), tie="event_id")
    pairs = F.transform(F.map_entries("by_status"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return stats.withColumn("by_status", F.array_join(pairs, "|"))


_COOLDOWN = """CASE WHEN status = 0 THEN 60 WHEN status BETWEEN 200 AND 299 THEN 0 WHEN status = 406 THEN 120
  WHEN status >= 500 THEN 60 END"""


@query(f"WITH {FETCH_SQL} SELECT event_id, status, CAST({_COOLDOWN} AS DOUBLE) AS cooldown_s FROM fetchlog")
def cooldown_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch_log(spark, sf_dir).select(
        "event_id", "status", fetchlog.cooldown_seconds(F.col("status")).alias("cooldown_s")
    )


_HEALTH = f"""ev AS (SELECT mirror, ts, status, event_id, row_number() OVER (PARTITION BY mirror ORDER BY ts, event_id) AS rn,
    {_COOLDOWN} AS cd FROM fetchlog),
health AS (SELECT mirror,
    arg_max(status, rn) FILTER (WHERE status <> 0) AS last_status,
    max(ts) FILTER (WHERE status BETWEEN 200 AND 299) AS last_success_ts,
    max(ts) FILTER (WHERE status <> 0) AS last_attempt_ts,
    count(*) - coalesce(max(rn) FILTER (WHERE status BETWEEN 200 AND 299), 0) AS consecutive_failures,
    arg_max(cd, rn) FILTER (WHERE cd IS NOT NULL) AS cd,
    arg_max(ts, rn) FILTER (WHERE cd IS NOT NULL) AS cd_ts
  FROM ev GROUP BY mirror),
cool AS (SELECT *, CASE WHEN cd > 0 THEN greatest(0.0, (epoch_us(cd_ts) - epoch_us(TIMESTAMP '{{now}}')) / 1000000.0 + cd) ELSE 0.0 END AS remaining FROM health)"""

_SOON = "2024-01-30 23:58:00"


@query(f"""WITH {FETCH_SQL}, {_HEALTH.format(now=_SOON)}
SELECT mirror, last_status, strftime(last_success_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_success_ts,
  strftime(last_attempt_ts, '%Y-%m-%d %H:%M:%S.%f') AS last_attempt_ts,
  CAST(consecutive_failures AS BIGINT) AS consecutive_failures, round(CAST(remaining AS DOUBLE), 1) AS cooldown_remaining_s FROM cool""")
def mirror_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every mirror shortly after the end of the log."""
    health = fetchlog.mirror_health(fetch_log(spark, sf_dir), F.lit(_SOON).cast("timestamp"))
    return health.withColumn("last_success_ts", _text_ts("last_success_ts")).withColumn(
        "last_attempt_ts", _text_ts("last_attempt_ts")
    )


@query(f"""WITH {FETCH_SQL}, {_HEALTH.format(now=_SOON)},
config(mirror, config_rank) AS (VALUES ('m2', 0), ('m0', 1), ('m1', 2), ('m9', 3)),
known AS (SELECT c.mirror, config_rank, last_success_ts, coalesce(round(CAST(remaining AS DOUBLE), 1) <= 0, true) AS usable
  FROM config c LEFT JOIN cool USING (mirror)),
cand AS (SELECT * FROM known WHERE usable OR NOT (SELECT max(usable) FROM known))
SELECT mirror, config_rank, usable,
  CAST(row_number() OVER (ORDER BY last_success_ts DESC NULLS LAST, config_rank) AS INT) AS rank FROM cand""")
def mirror_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirrors in the order they should be tried."""
    health = fetchlog.mirror_health(fetch_log(spark, sf_dir), F.lit(_SOON).cast("timestamp"))
    return fetchlog.rank_mirrors(health, MIRRORS)


_USAGE = [
    "concat('a', CAST(user_id % 20 AS STRING)) AS account",
    "ts",
    "event_id",
    "CASE WHEN event_type = 'error' THEN 'flood' WHEN event_type = 'purchase' THEN 'error' ELSE 'ok' END AS outcome",
    "CASE WHEN event_type = 'error' THEN CAST(event_id % 5000 AS DOUBLE) END AS flood_seconds",
]
_LATER = "2024-01-30 23:59:59"


@query(f"""WITH usage AS (SELECT {", ".join(_USAGE)} FROM events),
agg AS (SELECT account, count(*) FILTER (WHERE outcome = 'ok') AS success, count(*) FILTER (WHERE outcome <> 'ok') AS fail,
  coalesce(arg_max(flood_seconds, event_id) FILTER (WHERE outcome = 'flood'), 0.0) AS cooling_sec,
  max(ts) FILTER (WHERE outcome = 'flood') AS since FROM usage GROUP BY account)
SELECT account, CAST(success AS BIGINT) AS success, CAST(fail AS BIGINT) AS fail, CAST(cooling_sec AS DOUBLE) AS cooling_sec,
  coalesce(cooling_sec > 0 AND (epoch_us(TIMESTAMP '{_LATER}') - epoch_us(since)) / 1000000.0 < cooling_sec, false) AS is_cooling FROM agg""")
def account_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage and cool-down of every account."""
    usage = table(spark, sf_dir, "events").selectExpr(*_USAGE)
    return accounts.account_health(usage, F.lit(_LATER).cast("timestamp"), tie="event_id")


@query("""WITH acc AS (SELECT s_suppkey, s_name, row_number() OVER (ORDER BY s_suppkey) - 1 AS turn,
  count(*) OVER () AS n FROM supplier WHERE s_suppkey % 3 <> 0),
w AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
SELECT doc_id, s_name AS account FROM w JOIN acc ON idx % n = turn""")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents shared out over the suppliers that are not cooling, in turn."""
    work = table(spark, sf_dir, "documents").select("doc_id")
    pool = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("account"),
        F.col("s_suppkey").alias("account_rank"),
        (F.col("s_suppkey") % 3 == 0).alias("is_cooling"),
    )
    return accounts.assign_round_robin(work, pool, order_col="doc_id").select("doc_id", "account")


@query(f"""WITH {FETCH_SQL}, w AS (SELECT source, ts, status, CAST(ts AS DATE) - CAST(unnest(range(7)) AS INT) AS day FROM fetchlog)
SELECT source, strftime(day, '%Y-%m-%d') AS since, CAST(count(*) AS BIGINT) AS attempts,
  CAST(count(*) FILTER (WHERE NOT coalesce(status >= 200 AND status < 400, false)) AS BIGINT) AS failures,
  CAST(count(*) FILTER (WHERE status IN (429, 500, 502, 503, 504)) AS BIGINT) AS slowed,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
FROM w GROUP BY source, day""")
def windowed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts and failures per source over seven days, for every day they begin on."""
    out = fetchlog.windowed_health(fetch_log(spark, sf_dir))
    return out.select(
        "source", F.date_format("since", "yyyy-MM-dd").alias("since"), "attempts", "failures", "slowed", _text_ts("last_ts").alias("last_ts")
    )


@query(f"""WITH {FETCH_SQL}, f AS (
  SELECT source, ts, lag(ts) OVER (PARTITION BY source ORDER BY ts, event_id) AS before, event_id FROM fetchlog
  WHERE NOT coalesce(status >= 200 AND status < 400, false)),
n AS (SELECT source, ts, sum(CASE WHEN before IS NULL OR ts >= before + INTERVAL 1 HOUR THEN 1 ELSE 0 END)
  OVER (PARTITION BY source ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT source, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts,
  CAST(count(*) AS BIGINT) AS failures FROM n GROUP BY source, run""")
def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of a source that follow each other within an hour."""
    out = fetchlog.outages(fetch_log(spark, sf_dir))
    return out.select("source", _text_ts("first_ts").alias("first_ts"), _text_ts("last_ts").alias("last_ts"), "failures")
