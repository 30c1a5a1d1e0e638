"""Mix sources to target weights by hierarchical budgeting.

Weights go down a tree of domain, language and source. Each node's budget is dealt to its children by
weight; a child that cannot use its share (its tokens times ``max_epochs``) is filled and what it leaves goes
to its siblings in proportion to their weights. As a node's capacity is the sum of its children's, a
shortage moves to the siblings of an ancestor only when all siblings below are full. Each leaf then gives
whole epochs of its documents and the prefix of one more, in an order seeded per epoch: the documents
whose running sum of tokens is within the rest of the budget.

The tree has one row per source and is dealt by window sums. The prefix is cut by sums over hash ranges:
only the range in which the budget ends is ordered row by row, so no leaf is gathered in one task.

Defined results: a null domain, language or source is a leaf ``unknown``; an empty or null text has no
tokens and stays with every epoch that is given whole, never as part of a prefix, and a leaf without tokens
gives nothing; repeated rows count each time, and rows with one key stay or go together; a weight that is
missing is 1; an empty table gives an empty result. Input columns stay, a result column replaces one of its name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoingest.llm.common import packed, small_broadcast, staged, unpacked
from geoingest.llm.registry import query, table

SEED = 11
MAX_EPOCHS = 3
#: Upper bits of a leaf's order that name a range; the budget ends in one range of each leaf.
RANGE_BITS = 16
#: Tables with a row per leaf are broadcast up to this many leaves.
MOST_LEAVES = 100_000

#: Weights of the corpus at hand; what is not named weighs 1.
DOMAIN_WEIGHTS = {"web": 3.0, "reference": 2.0, "forum": 1.0, "archive": 1.0}
LANG_WEIGHTS = {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}
#: Five numbered sources each, in this order.
DOMAINS = ("web", "reference", "forum", "archive")


def domain_of(source: Column) -> Column:
    """Domain of a numbered source: five in a row belong together."""
    number = F.regexp_extract(source, r"(\d+)$", 1).try_cast("int")
    found = F.lit("unknown")
    for i, name in enumerate(DOMAINS):
        found = F.when((number >= 5 * i) & (number < 5 * i + 5), F.lit(name)).otherwise(found)
    return found


def weight_of(value: Column, weights: dict[str, float]) -> Column:
    found = F.lit(1.0)
    for name, weight in weights.items():
        found = F.when(value == name, F.lit(weight)).otherwise(found)
    return found


def n_tokens(text: Column) -> Column:
    """Words between ``[\\x20\\x09-\\x0D]``."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def deal(children: DataFrame, parents: list[str], budget: str, capacity: str, weight: str, out: str) -> DataFrame:
    """Deal each parent's ``budget`` to its children by ``weight``, none above its ``capacity``.

    Children fill up in the order of capacity over weight. Before each stand the capacities of those
    that fill earlier; the level at which it is the next to fill tells whether the budget gets there.
    """
    w = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    level = F.col(capacity) / F.col(weight)
    order = w.orderBy(level, *[F.col(c) for c in ("domain", "lang", "source") if c in children.columns])
    earlier = F.coalesce(F.sum(capacity).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    weights = F.sum(weight).over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    rated = children.withColumn("_rate", (F.col(budget) - earlier) / weights).withColumn("_level", level)
    # From the first child that the rate does not fill, all share what is left at that one rate. Rates fall
    # from there on, so it is the largest of them.
    unfilled = F.col("_rate") < F.col("_level")
    rated = rated.withColumn("_from", F.min(F.when(unfilled, F.col("_level"))).over(w))
    rated = rated.withColumn("_at", F.max(F.when(unfilled, F.col("_rate"))).over(w))
    share = F.when(F.col("_from").isNull() | (F.col("_level") < F.col("_from")), F.col(capacity))
    share = share.otherwise(F.col("_at") * F.col(weight))
    return rated.withColumn(out, F.greatest(F.least(share, F.col(capacity)), F.lit(0.0))).drop("_rate", "_level", "_from", "_at")


def budgets(leaves: DataFrame, total: Column | None, max_epochs: int, weights: dict[str, Column]) -> DataFrame:
    """From ``domain, lang, source, tokens`` per leaf to its ``budget`` in tokens; ``total`` defaults to all there are."""
    path = ["domain", "lang", "source"]
    tree = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    for name, weight in weights.items():
        tree = tree.withColumn(f"w_{name}", weight)
    langs = tree.groupBy("domain", "lang", "w_domain", "w_lang").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    domains = langs.groupBy("domain", "w_domain").agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    everything = F.sum("tokens").over(W.partitionBy(F.lit(0))).cast("double")
    domains = domains.withColumn("all", everything if total is None else total.cast("double"))
    domains = deal(domains, [], "all", "cap", "w_domain", "b_domain")
    langs = deal(langs.join(domains.select("domain", "b_domain"), "domain"), ["domain"], "b_domain", "cap", "w_lang", "b_lang")
    tree = tree.join(langs.select("domain", "lang", "b_lang"), ["domain", "lang"])
    tree = deal(tree, ["domain", "lang"], "b_lang", "cap", "w_source", "b_source")
    # A little is added so that whole numbers of tokens survive division.
    return tree.select(*path, "tokens", F.floor(F.col("b_source") + 1e-6).cast("long").alias("budget"))


def order_key(epoch: Column, key: Column, seed: int) -> Column:
    """Place in the order of an epoch: 60 bits that another engine can compute too."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix(
    df: DataFrame,
    domain: Column,
    lang: Column,
    source: Column,
    tokens: Column,
    key: Column,
    weights: dict[str, Column] | None = None,
    total: Column | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``df`` with ``domain, tokens, budget`` of their leaf and ``copies``, the epochs that hold the row.

    ``weights`` are columns over ``domain, lang, source``, under those three names.
    """
    rows = _mixed(df, domain, lang, source, tokens, key, weights, total, max_epochs, seed)
    return unpacked(rows, df.columns, **{n: F.col(n) for n in ("domain", "tokens", "budget", "copies")})


def _mixed(
    df: DataFrame,
    domain: Column,
    lang: Column,
    source: Column,
    tokens: Column,
    key: Column,
    weights: dict[str, Column] | None = None,
    total: Column | None = None,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """``row``, the leaf, ``tokens``, ``budget`` and ``copies``."""
    path = ["domain", "lang", "source"]
    named = [F.coalesce(c.cast("string"), F.lit("unknown")) for c in (domain, lang, source)]
    whole = packed(df, **dict(zip(path, named)), tokens=tokens, key=key)
    narrow = staged(whole.drop("row"), "mix-tokens")
    leaves = narrow.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
    dealt = budgets(leaves, total, max_epochs, {n: F.lit(1.0) for n in path} | (weights or {}))
    dealt = dealt.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("long"))
    dealt = dealt.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")).drop("tokens")
    dealt = staged(dealt, "mix-budgets")
    # One row per leaf; a leaf may hold a third of all documents.
    ordered = narrow.join(small_broadcast(dealt, MOST_LEAVES), path).where("rest > 0 and tokens > 0")
    ordered = ordered.select(*path, "tokens", "rest", order_key(F.col("epochs") + 1, F.col("key"), seed).alias("order"))
    ordered = ordered.withColumn("range", F.shiftright("order", 60 - RANGE_BITS))
    sums = ordered.groupBy(*path, "range", "rest").agg(F.sum("tokens").alias("sum"))
    w = W.partitionBy(*path).orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.sum("sum").over(w) - F.col("sum"))
    cuts = staged(sums.where("before + sum > rest and before <= rest").select(*path, "range", "before"), "mix-cuts")
    # Rows that tie in the order have one key; they are added up and go together.
    inside = ordered.join(small_broadcast(cuts, MOST_LEAVES), [*path, "range"])
    inside = inside.groupBy(*path, "range", "before", "rest", "order").agg(F.sum("tokens").alias("tokens"))
    w = W.partitionBy(*path, "range").orderBy("order").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("running", F.col("before") + F.sum("tokens").over(w)).where("running <= rest")
    ends = inside.groupBy(*path).agg(F.max("order").alias("last"))
    plain = cuts.select(*path, (F.shiftleft("range", 60 - RANGE_BITS) - 1).alias("below"))
    ends = dealt.join(plain, path, "left").join(ends, path, "left")
    ends = staged(ends.withColumn("end", F.when(F.col("rest") > 0, F.coalesce("last", "below"))), "mix-ends")
    own = (F.col("tokens") > 0) & (order_key(F.col("epochs") + 1, F.col("key"), seed) <= F.col("end"))
    joined = whole.join(small_broadcast(ends.select(*path, "budget", "epochs", "end"), MOST_LEAVES), path)
    return joined.withColumn("copies", F.col("epochs") + F.coalesce(own, F.lit(False)).cast("long"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """Documents at the weights above, with as many tokens in all as there are."""
    return _mixed(
        docs, domain_of(F.col("source")), F.col("lang"), F.col("source"), n_tokens(F.col("text")), F.col("doc_id"),
        {"domain": weight_of(F.col("domain"), DOMAIN_WEIGHTS), "lang": weight_of(F.col("lang"), LANG_WEIGHTS)},
    )


def _deal_sql(of: str, parents: str, budget: str, weight: str, out: str, names: str) -> str:
    """The same dealing in SQL: ``of`` has the children with ``cap`` and the parent's budget."""
    by = f"PARTITION BY {parents}" if parents else ""
    return f"""
        SELECT *, greatest(least(CASE WHEN first IS NULL OR cap / {weight} < level1 THEN cap ELSE first * {weight} END, cap), 0) AS {out}
        FROM (SELECT *, min(level) FILTER (WHERE rate < level) OVER v AS level1,
                     max(rate) FILTER (WHERE rate < level) OVER v AS first
              FROM (SELECT *, cap / {weight} AS level,
                           ({budget} - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                           / sum({weight}) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
                    FROM {of} WINDOW w AS ({by} ORDER BY cap / {weight}, {names}))
              WINDOW v AS ({by}))"""


def _case_sql(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1.0 END::DOUBLE"


_NUMBER = "TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INT)"
_DOMAIN_SQL = "CASE " + " ".join(f"WHEN {_NUMBER} BETWEEN {5 * i} AND {5 * i + 4} THEN '{d}'" for i, d in enumerate(DOMAINS)) + " ELSE 'unknown' END"
MIX_SQL = f"""
    WITH docs AS (
        SELECT doc_id, {_DOMAIN_SQL} AS domain, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
               len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
        FROM documents),
    leaves AS (
        SELECT domain, lang, source, sum(tokens)::BIGINT AS tokens, sum(tokens)::DOUBLE * {MAX_EPOCHS} AS cap,
               {_case_sql("domain", DOMAIN_WEIGHTS)} AS wd, {_case_sql("lang", LANG_WEIGHTS)} AS wl, 1.0::DOUBLE AS ws
        FROM docs GROUP BY ALL),
    d AS (SELECT domain, wd, sum(cap) AS cap, sum(sum(tokens)) OVER ()::DOUBLE AS total FROM leaves GROUP BY domain, wd),
    bd AS ({_deal_sql("d", "", "total", "wd", "b_domain", "domain")}),
    l AS (SELECT domain, lang, wl, sum(cap) AS cap, any_value(b_domain) AS b_domain
          FROM leaves JOIN (SELECT domain, b_domain FROM bd) USING (domain) GROUP BY domain, lang, wl),
    bl AS ({_deal_sql("l", "domain", "b_domain", "wl", "b_lang", "lang")}),
    s AS (SELECT leaves.*, b_lang FROM leaves JOIN (SELECT domain, lang, b_lang FROM bl) USING (domain, lang)),
    b AS (SELECT domain, lang, source, tokens AS leaf_tokens, floor(b_source + 1e-6)::BIGINT AS budget
          FROM ({_deal_sql("s", "domain, lang", "b_lang", "ws", "b_source", "source")})),
    e AS (SELECT *, CASE WHEN leaf_tokens > 0 THEN budget // leaf_tokens ELSE 0 END AS epochs FROM b),
    o AS (SELECT docs.*, budget, epochs, budget - epochs * leaf_tokens AS rest,
                 ('0x' || substr(md5('{SEED}:' || (epochs + 1) || ':' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
          FROM docs JOIN e USING (domain, lang, source))
    SELECT doc_id, domain, lang, source, tokens, budget,
           epochs + (tokens > 0 AND rest > 0 AND sum(tokens) OVER (
               PARTITION BY domain, lang, source ORDER BY place RANGE UNBOUNDED PRECEDING) <= rest)::BIGINT AS copies
    FROM o
"""


@query(MIX_SQL)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = mix_documents(docs)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "domain", "lang", "source", "tokens", "budget", "copies")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: each document as many times as the mixture takes it."""
    rows = mix_documents(docs).where("copies > 0")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return unpacked(rows, docs.columns)
