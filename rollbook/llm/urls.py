"""URL filters: host-suffix and path-prefix expressions against hashed rules.

Every host suffix at a label border times every path prefix of a length that
some rule has is one expression.  Expressions meet rules by an equi-join on
a short prefix of their digests; the whole digest then confirms, and the
longest rule wins.  Addresses are judged once each, so a hot page costs no
more than a rare one, and rules are broadcast only if Catalyst finds them
below its threshold.

Defined cases: a null address or one without ``://`` has an empty host and
path and takes the default verdict; an empty path starts with no rule's path;
repeated rows give equal rows; no rules at all leaves the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as the rules see them; both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``rules`` has (host, path, verdict); a rule fits its host and subdomains
    where the page's path starts with the rule's.
    """
    listed = rules.select(F.concat("host", "path").alias("rule"), F.length("path").alias("size"), F.col("verdict").alias("ruled"))
    digest = listed.select("rule", "ruled", F.sha2(F.col("rule"), 256).alias("rule_digest"))
    digest = digest.withColumn("short", F.substring("rule_digest", 1, PREFIX_HEX))
    # The rules' distinct path lengths: no more than the longest path has characters.
    sizes = sorted(r["size"] for r in listed.select("size").distinct().toLocalIterator())
    seen = pages.select(F.col("page_id"), F.col("url").cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    seen = seen.select("page_id", host.alias("host"), path.alias("path"))

    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    lengths = F.filter(F.array(*[F.lit(n) for n in sizes]), lambda n: n <= F.length("path")) if sizes else F.expr("cast(array() as array<int>)")
    made = F.flatten(F.transform(suffixes, lambda s: F.transform(lengths, lambda n: F.concat(s, F.col("path").substr(F.lit(1), n)))))
    expressions = seen.select("host", "path").distinct().select("host", "path", F.explode(F.array_distinct(made)).alias("expression"))
    expressions = expressions.withColumn("digest", F.sha2("expression", 256)).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    hits = expressions.join(digest, "short").where(F.col("digest") == F.col("rule_digest"))
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "ruled")).alias("best"))
    out = seen.join(best, ["host", "path"], "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.ruled", F.lit(default)).alias("verdict"))
