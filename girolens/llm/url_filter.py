"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed on full digests.

Only DataFrame operations: nothing here runs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules beyond this number are joined by a shuffle instead of a broadcast.
BROADCAST_RULES = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://` or for null."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring_index(F.regexp_replace(url, r"(?s)^.*?://", "://"), "#", 1))
    rest = F.substring_index(F.regexp_replace(F.coalesce(rest, F.lit("")), r"^://", ""), "?", 1)
    host = F.substring_index(rest, "/", 1)
    return F.translate(host, _UPPER, _LOWER), F.substr(rest, F.length(host) + 1)


def _expression(host: Column, path: Column) -> Column:
    return F.concat(host, path)


def _prefix(expression: Column, bits: int) -> Column:
    """The first bits of the SHA-256 of an expression, as a number."""
    return F.conv(F.substring(F.sha2(expression, 256), 1, bits // 4), 16, 10).cast("long")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", bits: int = 32,
          broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """`pages` with host, path, rule and verdict; `rules` has host, path and verdict.

    A rule fits its host and the subdomains of it, for paths that start with its path. The longest rule (host and path
    together, then the longer host) wins; of equal rules `block` wins. Without a rule, `rule` is null and `verdict` is
    `default`. Null URLs and URLs without `://` have empty host and path, which no rule fits. Rules with null parts are
    left out. Repeated rows stay repeated. Columns of `pages` with the names of the new ones are replaced.

    Each distinct (host, path) is judged once, so copies of a hot URL collapse before the join; the partial aggregate
    does that in every task. Expressions are only made for path lengths that rules have. The join is on the short
    prefix of the digest; the full digest, host and path are compared afterwards.
    """
    host, path = host_and_path(F.col(url))
    known = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"),
                         F.col("verdict").alias("r_verdict")).dropna().distinct()
    shown = _expression(F.col("r_host"), F.col("r_path"))
    known = known.withColumn("digest", F.sha2(shown, 256)).withColumn("short", _prefix(shown, bits))
    few = known.limit(broadcast_rules + 1).count() <= broadcast_rules
    lengths = known.select(F.length("r_path").alias("n")).distinct()
    sizes = lengths.agg(F.array_sort(F.collect_set("n")).alias("sizes"))  # as many as path lengths: a few thousand

    places = pages.select(host.alias("host"), path.alias("path")).distinct()
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    prefixes = F.transform(F.filter("sizes", lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    wanted = places.where(F.col("host") != "").withColumn("sizes", sizes.scalar())
    wanted = wanted.select("host", "path", F.explode(F.array_distinct(suffixes)).alias("h"), prefixes.alias("ps"))
    wanted = wanted.select("host", "path", "h", F.explode("ps").alias("p"))
    made = _expression(F.col("h"), F.col("p"))
    wanted = wanted.withColumn("made", F.sha2(made, 256)).withColumn("short", _prefix(made, bits))
    hits = wanted.join(F.broadcast(known) if few else known, "short").where(
        (F.col("made") == F.col("digest")) & (F.col("h") == F.col("r_host")) & (F.col("p") == F.col("r_path")))
    rank = F.struct(F.length(shown).alias("length"), F.length("r_host").alias("host_length"),
                    (F.col("r_verdict") == "block").cast("int").alias("block"), shown.alias("rule"),
                    F.col("r_verdict").alias("verdict"))
    best = hits.groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path")).agg(F.max(rank).alias("best"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), host.alias("host"), path.alias("path"))
    joined = rows.join(best, (rows["host"] == best["b_host"]) & (rows["path"] == best["b_path"]), "left")
    own = [F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return joined.select(*own, "host", "path", F.col("best.rule").alias("rule"),
                         F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
