"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as ``assistant`` and all
others as named users; the mask covers what that speaker says, closing mark included, and nothing else. A
system turn opens no perspective and is rendered as ``system`` in each.

A conversation of any length is rendered in parts: the turns of one span of ``PART_TURNS`` turn numbers, so no
conversation is gathered in one task. A turn number that many rows share is cut further, in the order in
which its rows are rendered. Parts of one conversation and speaker follow each other in the order of
``part``; mask places are counted in code points from the start of each part.

Defined results: a null role speaks as ``unknown``; a null text is an empty turn; a null turn number comes last; a
null conversation is one of its own; every row is a turn, also one that repeats another word for word; rows of one
turn number are ordered by the first 32 bits of the SHA-256 of their text, then by role, then by text; copies of a row
beyond ``TURN_ROWS`` go to pieces that follow the others; the format's own marks inside a text are broken by a space; a
conversation of system turns only has no perspective; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.llm.common import staged
from geoingest.llm.registry import query, table

# Fixed values of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM_ROLE, NO_ROLE = "system", "unknown"
#: Turn numbers that one part spans; rows of one turn number that stay with it.
PART_TURNS = 64
#: A larger turn is cut by hash into pieces of about so many rows.
TURN_ROWS = 256


def unmarked(text: Column) -> Column:
    """Text without the format's marks: a space keeps ``<`` and ``|`` apart."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their ``part``: span, turn and piece for a crowded turn, else the span alone."""
    each = df.select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(NO_ROLE)).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    # Equal rows are counted, so that copies can be numbered without a window over them.
    counted = each.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    hash_ = F.conv(F.substring(F.sha2("text", 256), 1, 8), 16, 10).cast("long")
    counted = staged(counted.withColumn("hash", hash_), "turns")
    crowded = counted.groupBy("conv_id", "turn").agg(F.sum("copies").alias("n")).where(F.col("n") > TURN_ROWS)
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    same = (F.col("r.conv_id").eqNullSafe(F.col("c.conv_id"))) & (F.col("r.turn").eqNullSafe(F.col("c.turn")))
    pieces = F.ceil(F.col("c.n") / TURN_ROWS)
    # The hash runs evenly from 0 to 2^32: its place in that range names the piece, and pieces keep the order.
    piece = F.floor(F.col("r.hash") * pieces / 2.0**32) + F.floor(F.col("r.copy") / TURN_ROWS) * pieces
    most = F.lit(2**63 - 1).cast("long")
    span = F.coalesce(F.floor(F.col("r.turn") / PART_TURNS), most)
    part = F.struct(
        span.cast("long").alias("span"),
        F.when(F.col("c.n").isNotNull(), F.coalesce(F.col("r.turn"), most)).otherwise(-1).cast("long").alias("turn"),
        F.coalesce(piece, F.lit(0)).cast("long").alias("piece"),
    )
    return rows.alias("r").join(crowded.alias("c"), same, "left").select("r.*", part.alias("part"))


def rotate(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, speaker, part, n_turns, text, mask``: one row per conversation, participant and part.

    ``mask`` is an array of ``start, end`` (end exclusive) of what the speaker is to learn.
    """
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    speakers = turns.where(F.col("role") != SYSTEM_ROLE).select("conv_id", F.col("role").alias("speaker")).distinct()
    rows = turns.alias("t").join(speakers.alias("s"), F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")))
    own = F.col("role") == F.col("speaker")
    name = F.regexp_replace(F.col("role"), r"[^\p{L}\p{N}_.-]", "_")
    head = F.when(own, F.lit("assistant")).when(F.col("role") == SYSTEM_ROLE, F.lit(SYSTEM_ROLE))
    opening = F.concat(F.lit(OPEN), F.coalesce(head, F.concat(F.lit("user name="), name)), F.lit("\n"))
    said = F.concat(unmarked(F.col("text")), F.lit(CLOSE))
    rows = rows.select(
        F.col("t.conv_id").alias("conv_id"),
        "speaker",
        "part",
        F.struct(
            F.col("turn").isNull().alias("last"), "turn", "hash", "role", "text", opening.alias("opening"), said.alias("said"), own.alias("own")
        ).alias("x"),
    )
    # A part holds at most PART_TURNS turn numbers of TURN_ROWS rows each, or one piece of a crowded turn, copies side by side.
    parts = rows.groupBy("conv_id", "speaker", "part").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    text = F.array_join(F.transform("xs", lambda x: F.concat(x["opening"], x["said"], F.lit("\n"))), "")
    step = F.aggregate(
        "xs",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("mask")),
        lambda so_far, x: _add(so_far, x),
        lambda so_far: so_far["mask"],
    )
    return parts.select("conv_id", "speaker", "part", F.size("xs").alias("n_turns"), text.alias("text"), step.alias("mask"))


def _add(so_far: Column, x: Column) -> Column:
    start = so_far["at"] + F.length(x["opening"])
    end = start + F.length(x["said"])
    mask = F.when(x["own"], F.concat(so_far["mask"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(so_far["mask"])
    return F.struct((end + 1).alias("at"), mask.alias("mask"))


_SQL = f"""
    WITH each AS (
        SELECT conv_id, turn, coalesce(role, '{NO_ROLE}') AS role, coalesce(text, '') AS text, count(*) AS n FROM conversations GROUP BY ALL),
    turns AS (
        SELECT *, ('0x' || substring(sha256(text), 1, 8))::BIGINT AS h, sum(n) OVER (PARTITION BY conv_id, turn) AS crowd, unnest(range(n)) AS copy FROM each),
    parts AS (
        SELECT *, coalesce(CAST(floor(turn / {PART_TURNS}.0) AS BIGINT), 9223372036854775807) AS span,
               CASE WHEN crowd > {TURN_ROWS} THEN coalesce(turn, 9223372036854775807) ELSE -1 END AS part_turn,
               CASE WHEN crowd > {TURN_ROWS} THEN CAST(floor(h * ceil(crowd / {TURN_ROWS}.0) / 4294967296.0) + copy // {TURN_ROWS} * ceil(crowd / {TURN_ROWS}.0) AS BIGINT)
                    ELSE 0 END AS piece
        FROM turns),
    speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM turns WHERE role <> '{SYSTEM_ROLE}'),
    said AS (
        SELECT p.*, speaker, role = speaker AS own,
               '{OPEN}' || CASE WHEN role = speaker THEN 'assistant' WHEN role = '{SYSTEM_ROLE}' THEN role
                                ELSE 'user name=' || regexp_replace(role, '[^\\pL\\pN_.-]', '_', 'g') END || chr(10) AS opening,
               replace(text, '<|', '< |') || '{CLOSE}' AS body
        FROM parts p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
    placed AS (
        SELECT *, sum(length(opening) + length(body) + 1) OVER (
            PARTITION BY conv_id, speaker, span, part_turn, piece ORDER BY turn NULLS LAST, h, role, text, copy ROWS UNBOUNDED PRECEDING) - 1 AS stop
        FROM said)
    SELECT conv_id, speaker, span, part_turn, piece, count(*)::INT AS n_turns,
           sha256(string_agg(opening || body || chr(10), '' ORDER BY turn NULLS LAST, h, role, text, copy)) AS text_sha256,
           coalesce(string_agg((stop - length(body))::BIGINT || ':' || stop::BIGINT, ',' ORDER BY stop) FILTER (WHERE own), '') AS mask
    FROM placed GROUP BY conv_id, speaker, span, part_turn, piece
"""


@query(_SQL)
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    where = [F.col("part.span").alias("span"), F.col("part.turn").alias("part_turn"), F.col("part.piece").alias("piece")]
    return parts.select("conv_id", "speaker", *where, "n_turns", F.sha2("text", 256).alias("text_sha256"), spans.alias("mask"))
