"""Account usage: cool-down state and static sharing of work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoingest.operators.ordering import with_row_index

MAX_BROADCAST_ACCOUNTS = 100_000


def account_health(usage: DataFrame, now: Column, *, tie: str | None = None) -> DataFrame:
    """Successes, failures and cool-down per account.

    ``usage(account, ts, outcome, flood_seconds)`` with outcome ``ok``, ``flood`` or ``error``; only a
    flood wait sets a cool-down, the latest one counts.
    """
    flood = F.col("outcome") == "flood"
    order = F.struct("ts", *([tie] if tie else []))
    since = F.max(F.when(flood, F.col("ts")))
    grouped = usage.groupBy("account").agg(
        F.count_if(F.col("outcome") == "ok").alias("success"),
        F.count_if(F.col("outcome") != "ok").alias("fail"),
        F.coalesce(
            F.max_by(
                F.when(flood, F.coalesce(F.col("flood_seconds").cast("double"), F.lit(0.0))),
                F.when(flood, order),
            ),
            F.lit(0.0),
        ).alias("cooling_sec"),
        since.alias("_since"),
    )
    waited = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("_since").cast("timestamp"))) / 1e6
    cooling = (F.col("cooling_sec") > 0) & (waited < F.col("cooling_sec"))
    return grouped.select(
        "account", "success", "fail", "cooling_sec", F.coalesce(cooling, F.lit(False)).alias("is_cooling")
    )


def assign_round_robin(
    work: DataFrame, accounts: DataFrame, *, order_col: str = "_pos", account_order: str = "account_rank"
) -> DataFrame:
    """Share ``work`` out over the non-cooling ``accounts(account, <rank>, is_cooling)`` in turn.

    ``order_col`` and the account rank are unique integers. The account list is broadcast when it is
    small; a longer one is joined on the turn number, where no turn holds a notable share of the work.
    """
    usable = accounts.where("not is_cooling").select("account", account_order)
    n = usable.count()
    if n == 0:
        raise ValueError("all accounts are cooling down")
    turns = with_row_index(usable, account_order, "_turn").select("account", "_turn")
    if n <= MAX_BROADCAST_ACCOUNTS:
        turns = F.broadcast(turns)
    return (
        with_row_index(work, order_col)
        .withColumn("_turn", F.pmod(F.col("_idx"), F.lit(n)))
        .join(turns, "_turn")
        .drop("_turn", "_idx")
    )
