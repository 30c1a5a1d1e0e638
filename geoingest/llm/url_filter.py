"""URL filters: host and path rules, and for the other urls logistic regression on hashed character n-grams.

A rule fits its host and all subdomains when the url's path starts with the rule's; the longest rule wins.
What no rule judges goes to a logistic regression over hashed character n-grams of host and path. It is
fitted on a small labelled table of urls, ``labelled_table`` if no other is given: hosts named after what is to be
blocked and after ordinary subjects, each with the same endings, languages and numbers, so that only the names tell
them apart; it knows nothing of the rules. Parsing, rules, n-grams, hashing and the model run as SQL functions and
Spark ML, without Python.

Defined results: a null url, or one without ``://``, has an empty host and path, which no rule fits, and is
judged by the model from no n-grams at all; without labelled urls the model allows everything; rows are
neither merged nor dropped; an empty table gives an empty result. Input columns stay, a result column
replaces one of its name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoingest.llm.common import packed, staged, unpacked
from geoingest.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the contract, as verdict by host and path.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}
SIZES = (3, 4, 5)
FEATURES = 1 << 14
#: Ridge penalty of the regression.
PENALTY = 1e-3
#: The labelled table: words that name hosts to block and hosts to allow, and what either stands beside.
BLOCKED = (
    "casino poker slots jackpot roulette bingo bets betting gambling lottery pills pharmacy viagra meds diet adult xxx porn escort webcam "
    "spam ads adserver banner popup tracker track click malware warez crack keygen torrent loans payday replica prize winner giveaway bonus"
).split()
ALLOWED = (
    "library university museum school news weather recipes garden history science gazette journal council hospital theatre "
    "music travel maps forum wiki archive review research physics chess football cycling harbour village nation station "
    "garden weaving leather feather northern southern mother father brother motion notion section edition tradition location fashion "
    "passion winter summer river forest mountain letters reading teaching housing building painting ashore inland thinking"
).split()
BESIDE = "win free cheap best online farm x shop world club".split()
BESIDE_ALLOWED = "city daily national open home old green world club online".split()
PAGES = 6
_FRONT, _END, _LANG = ("", "www.", "m.", "blog."), ("com", "net", "org"), ("en", "de", "fr", "es")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null; of equally long ones the smaller."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), [-ord(c) for c in r])):
        of, slash, rest = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    return reduce(lambda so_far, r: F.when(rule == r, F.lit(rules[r])).otherwise(so_far), rules, F.lit(None).cast("string"))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of the host, its ends marked, and of the path; each knows where it is from."""

    none = F.array().cast("array<string>")

    def of_size(points: Column, mark: str, n: int) -> Column:
        gram = lambda i: F.concat(F.lit(mark), *[F.get(points, i + j) for j in range(n)])
        return F.when(F.size(points) >= n, F.transform(F.sequence(F.lit(0), F.size(points) - n), gram)).otherwise(none)

    def of(part: Column, mark: str) -> Column:
        # Code points as an array of their own, bound once: the work grows with the length of the url, not its square.
        points = F.regexp_extract_all(F.concat(F.lit("^"), part, F.lit("$")), F.lit("(?s)."), F.lit(0))
        found = F.flatten(F.transform(F.array(points), lambda p: F.concat(*[of_size(p, mark, n) for n in SIZES])))
        return F.when(F.length(part) > 0, found).otherwise(none)

    return F.concat(of(host, "h"), of(path, "p"))


def labelled_table(spark: SparkSession) -> DataFrame:
    """``host, path, label`` (1: block): each word alone and beside others, before and after them, on ``PAGES`` pages each."""
    rows = []
    for words, beside, label in ((BLOCKED, BESIDE, 1.0), (ALLOWED, BESIDE_ALLOWED, 0.0)):
        for i, word in enumerate(words):
            first, second = beside[i % len(beside)], beside[(i + 3) % len(beside)]
            for k, name in enumerate((word, f"{word}-{first}", f"{second}-{word}", f"{word}{second}")):
                at = 4 * i + k
                for j in range(PAGES):
                    host = f"{_FRONT[(at + j) % 4]}{name}.example.{_END[(at + j) % 3]}"
                    rows.append((host, f"/{_LANG[(at // 4 + j) % 4]}/{(at * 370 + j * 1999 + 11) % 10_000}" + (".html", "/", "")[(at + j) % 3], label))
    return spark.createDataFrame(rows, "host string, path string, label double")


def fit(labelled: DataFrame) -> tuple[HashingTF, object]:
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features")
    rows = labelled.select("label", grams(F.col("host"), F.col("path")).alias("grams"))
    regression = LogisticRegression(regParam=PENALTY, standardization=False, maxIter=200, tol=1e-8)
    return hashing, regression.fit(hashing.transform(rows))


def judge(df: DataFrame, labelled: DataFrame | None = None, rules: dict[str, str] = RULES, url_col: str = "url") -> DataFrame:
    """The rows of ``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``p_block``, the model's probability.

    ``labelled(host, path, label)`` is the small table to fit on, ``labelled_table`` by default.
    """
    url = F.col(f"`{url_col}`")
    rows = packed(df, host=host_of(url), path=path_of(url)).withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    small = labelled_table(df.sparkSession) if labelled is None else staged(labelled, "labelled-urls")
    if small.limit(1).count():
        hashing, model = fit(small)
        scored = model.transform(hashing.transform(rows.withColumn("grams", grams(F.col("host"), F.col("path")))))
        scored = scored.withColumn("p_block", vector_to_array("probability")[1])
    else:
        scored = rows.withColumn("p_block", F.lit(0.0))
    by_model = F.when(F.col("p_block") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), by_model)
    results = {n: F.col(n) for n in ("host", "path", "rule")} | {"verdict": verdict, "p_block": F.col("p_block")}
    return unpacked(scored, df.columns, **results)


@query()
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
