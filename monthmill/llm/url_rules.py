"""URL filters: host-suffix and path-prefix expressions joined with rules on short hash prefixes.

Only DataFrame functions. A URL is expanded no deeper than the deepest rule, which loses nothing and bounds the rows that
a URL of many labels or segments can make. Matches are confirmed by the whole digest, so a clash of short prefixes costs
a comparison and never a wrong verdict. The optimizer picks the join from the rules' real size; beyond a broadcast it is
a shuffle whose hot expressions (`com/`) adaptive execution splits. A page's expressions meet again by a row number of its
own, so a hot host or URL gathers nowhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that the join compares.
PREFIX_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#`; path: from there up to `?`, `#`. Without `://` both are empty."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) with verdict allow or block."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def _expressions(host: Column, path: Column, labels: Column, slashes: Column) -> Column:
    """Every host suffix of at most `labels` labels with every path prefix that ends at one of the first slashes or is empty."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    kept = F.least(F.size(parts), labels)
    suffixes = F.transform(F.sequence(F.lit(1), kept), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    depth = F.least(F.size(steps) - 1, slashes)
    prefixes = F.transform(F.sequence(F.lit(0), depth), lambda n: F.when(n == 0, "").otherwise(F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each row of `pages`.

    A rule fits its host and all subdomains where the path starts with the rule's. The longest rule (host and path
    together) wins, of equal ones block, then the text that sorts last. A URL without a fitting rule, NULL included, has rule NULL
    and verdict `default`. Rules without host or path are taken as empty; an empty host fits nothing but itself. Repeated pages
    and rules are judged as often as they come; other columns are ignored.
    """
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    rules = rules.select(F.translate(host, UPPER, LOWER).alias("r_host"), path.alias("r_path"), F.col("verdict").alias("r_verdict"))
    to_slash = F.regexp_extract("r_path", r"^(?s:.*)/", 0)
    rules = rules.withColumn("r_digest", _digest(F.concat("r_host", to_slash)))
    keyed = rules.withColumn("r_key", F.substring("r_digest", 1, PREFIX_DIGITS)).where(F.col("r_verdict").isin("allow", "block"))
    labels = rules.agg(F.coalesce(F.max(F.size(F.split("r_host", r"\."))), F.lit(1))).scalar()
    slashes = rules.agg(F.coalesce(F.max(F.size(F.split("r_path", "/")) - 1), F.lit(0))).scalar()

    host, path = host_and_path(F.col("url").cast("string"))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("labels", labels).withColumn("slashes", slashes)
    asked = urls.select("row", "page_id", "host", "path", F.explode(_expressions(F.col("host"), F.col("path"), F.col("labels"), F.col("slashes"))).alias("e"))
    asked = asked.withColumn("digest", _digest(F.col("e"))).withColumn("key", F.substring("digest", 1, PREFIX_DIGITS)).drop("e")
    fits = (F.col("key") == F.col("r_key")) & (F.col("digest") == F.col("r_digest")) & F.startswith("path", "r_path")
    name = F.concat("r_host", "r_path")
    rank = F.struct(F.length(name).alias("n"), F.col("r_verdict").alias("verdict"), F.when(F.col("r_host").isNotNull(), name).alias("rule"))
    best = F.max(F.when(F.col("r_host").isNotNull(), rank)).alias("best")
    found = asked.join(keyed, fits, "left").groupBy("row").agg(*(F.any_value(c).alias(c) for c in ("page_id", "host", "path")), best)
    return found.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
