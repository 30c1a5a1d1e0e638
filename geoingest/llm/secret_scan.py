"""Secret scans over an incremental ledger of blobs.

Every historical version of a text is named by the SHA-256 of its content. The ledger says which rule
versions have been run over which blob, and what they found; a run scans only pairs of blob and rule
version the ledger lacks, appends them, and joins the findings to all paths that hold the blob. All of it
is SQL functions; positions follow from the lengths between and of the matches.

Only names of blobs are grouped and compared with the ledger; of each blob that needs a scan one path's
text is read. A blob that a third of all paths share is one scan, and its findings are broadcast back.

Defined results: a null text counts as empty and has no findings; paths are neither merged nor dropped, so
repeated rows repeat; overlapping findings of different kinds are all reported; an empty table gives an
empty result. The columns of the input, but the text, come back in the struct ``row``, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from geoingest.llm.common import join_groups, staged, staging_path
from geoingest.llm.registry import query, table


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The words and forms that count as secrets.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_ASSIGN = "(" + "|".join(map(_either_case, _NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: In the order in which kinds at one start are listed.
RULES = (
    Rule("assign", 1, _ASSIGN, 2, 8),
    # A run that is too short is no match of the longer forms either, wherever in the run they begin.
    Rule("access", 1, "AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", 1, "[0-9a-f]{32,}", 0, 32),
)
LEDGER_SCHEMA = "blob string, rule string, pos int, start long, end long"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Rows per blob and rule version: one per finding, and one without a place that says the pair was scanned."""
    try:
        found = spark.read.schema(LEDGER_SCHEMA).parquet(path)
        return found.dropDuplicates(["blob", "rule", "pos"])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def _lengths(parts: Column) -> Column:
    return F.transform(parts, F.length)


def _matches(text: Column, rule: Rule) -> Column:
    """Lengths before each match, of each match, and of its group; the last entry is the text's end."""
    found = F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.least).alias("least"),
        F.when(
            text.rlike(rule.pattern),
            F.arrays_zip(
                _lengths(F.split(text, rule.pattern, -1)).alias("gap"),
                _lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).alias("len"),
                _lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))).alias("value"),
            ),
        ).alias("parts"),
    )
    return F.when(F.array_contains("todo", rule.name), found)


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``blob, text, todo``; the same blob may come more than once."""
    pairs = texts.select("blob", F.explode(F.array(*[_matches(F.col("text"), r) for r in rules])).alias("m"))
    parts = pairs.where("m is not null").select("blob", "m.rule", "m.least", F.posexplode_outer("m.parts").alias("pos", "part"))
    # One row per match and one for the end, which also stands for a text without matches.
    rows = parts.select("blob", "rule", "least", F.coalesce("pos", F.lit(0)).alias("pos"), "part.*").distinct()
    w = W.partitionBy("blob", "rule").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(w)
    placed = rows.withColumn("end", end).where("len is null or value >= least")
    start = F.when(F.col("len").isNotNull(), F.col("end") - F.col("len"))
    return placed.select("blob", "rule", "pos", start.alias("start"), F.when(F.col("len").isNotNull(), F.col("end")).alias("end"))


def update_ledger(df: DataFrame, blobs: DataFrame, ledger: str, text: Column, key: Column, rules: tuple[Rule, ...]) -> None:
    """Scan what the ledger at that path lacks of ``blobs(blob, key)``, and append it in one commit."""
    seen = read_ledger(df.sparkSession, ledger).groupBy("blob").agg(F.collect_set("rule").alias("seen"))
    wanted = blobs.groupBy("blob").agg(F.min("key").alias("key"))
    left = F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("seen", F.array().cast("array<string>")))
    todo = staged(wanted.join(seen, "blob", "left").withColumn("todo", left).where("size(todo) > 0").drop("seen"), "blobs-to-scan")
    texts = df.select(text.alias("text"), key.alias("key")).withColumn("blob", F.sha2("text", 256))
    chosen = texts.join(todo.hint("merge"), ["blob", "key"])
    scan(chosen.select("blob", "text", "todo"), rules).write.mode("append").parquet(ledger)


def scan_secrets(
    df: DataFrame, ledger: str, text_col: str = "text", key_col: str = "doc_id", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``row`` (the columns of ``df`` but the text), ``blob``, ``key`` and ``findings``, ordered; null if there are none."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit(""))
    paths = staged(_paths(df, text, key, text_col), "paths")
    update_ledger(df, paths.select("blob", "key"), ledger, text, key, rules)
    known = read_ledger(df.sparkSession, ledger).where("start is not null")
    order, kind = F.lit(None).cast("int"), F.lit(None).cast("string")
    for i, rule in enumerate(rules):
        order = F.when(F.col("rule") == rule.name, F.lit(i)).otherwise(order)
        kind = F.when(F.col("rule") == rule.name, F.lit(rule.kind)).otherwise(kind)
    finding = F.struct("start", order.alias("order"), "end", kind.alias("kind"))
    # As many as one text holds; findings of other rule versions are not asked for.
    by_blob = known.where(order.isNotNull()).groupBy("blob").agg(F.array_sort(F.collect_list(finding)).alias("findings"))
    sizes = paths.groupBy("blob").agg(F.count("*").alias("paths"))
    return join_groups(paths, staged(by_blob.join(sizes, "blob"), "findings"), "blob", "paths", "left")


def _paths(df: DataFrame, text: Column, key: Column, text_col: str) -> DataFrame:
    """Every path's row without its text, the blob and a key to fetch the text by."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != text_col])
    return df.select(row.alias("row"), F.sha2(text, 256).alias("blob"), key.alias("key"))


def _sql_spans(rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
        SELECT doc_id, '{rule.kind}' AS kind, {RULES.index(rule)} AS o, e - m AS s, e FROM (
            SELECT doc_id, len(m) AS m, v, sum(len(g) + len(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
                SELECT doc_id, unnest(string_split_regex(text, '{pattern}')) AS g,
                       unnest(regexp_extract_all(text, '{pattern}')) AS m,
                       unnest(regexp_extract_all(text, '{pattern}', {rule.group})) AS v,
                       generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS i
                FROM documents WHERE regexp_matches(text, '{pattern}')))
        WHERE m IS NOT NULL AND len(v) >= {rule.least}"""


SECRETS_SQL = f"""
    WITH spans AS ({" UNION ALL ".join(map(_sql_spans, RULES))}),
    listed AS (
        SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in RULES)},
               string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, o, e) AS spans
        FROM spans GROUP BY doc_id)
    SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in RULES)},
           sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed USING (doc_id)
"""


@query(SECRETS_SQL)
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over all documents: an empty ledger of its own."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, staging_path(spark, "secret-ledger"))
    listed = F.coalesce("findings", F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>"))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(listed, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in RULES]
    return found.select(F.col("row.doc_id").alias("doc_id"), *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))
