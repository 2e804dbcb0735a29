"""URL rules by hashed lookup expressions (operator 3).

Each URL is expanded into (host suffix + path prefix) expressions, the
expressions meet the rules in an equi-join on a short prefix of their SHA-256
digest, the full digest and the texts confirm a hit, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import ascii_lower
from stratum.operators.joins import join_small, skew_join


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; '' when there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' when there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their digest. A repeated (host, path) keeps
    ``block`` over ``allow`` (the smaller-risk reading of a contradictory list)."""
    r = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    text = F.concat("host", "path")
    return r.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"),
                    F.col("verdict").alias("r_verdict"), text.alias("rule"), digest(text).alias("r_digest"))


def rule_shapes(rules: DataFrame) -> list[tuple[int, int]]:
    """The distinct (labels in the host, length of the path) of the rules. Only
    expressions of these shapes can equal a rule, so a URL is expanded into
    these and no others: exact for any rule, also one whose path does not end
    in a slash. Bounded by 127 host labels times the rule paths' lengths."""
    shape = rules.select(F.size(F.split("r_host", r"\.")).alias("n"), F.length("r_path").alias("p")).distinct()
    return sorted((r.n, r.p) for r in shape.collect())


def apply_url_rules(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
    default: str = "allow", prefix_hex: int = 8,
) -> DataFrame:
    """(id, host, path, rule, verdict) of every page; other columns are left out.

    Null URLs and URLs without ``://`` have empty host and path and no rule:
    ``default``. Repeated rows (also with a null id) stay repeated. Of two fitting
    rules of equal length the one with the longer host wins. An empty rule
    table gives every page the default.

    Scale: the verdict depends on the URL alone, so the expressions are made
    once for each distinct (host, path) – a map-side aggregate, which also
    reduces a hot URL to one row per task – and joined back; the rules are
    broadcast only when counted small, else shuffled on the hash prefix.
    """
    base = pages.select(F.col(id_col).alias(id_col), url_host(F.col(url_col)).alias("host"),
                        url_path(F.col(url_col)).alias("path"))
    hashed = hashed_rules(rules)
    hashed = hashed.withColumn("prefix", F.substring("r_digest", 1, prefix_hex))
    shapes = rule_shapes(hashed)
    if not shapes:
        return base.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    shape_type = "array<struct<n:int,p:int>>"
    grid = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(p).alias("p")) for n, p in shapes]).cast(shape_type)
    urls = base.where(F.col("host") != "").select("host", "path").distinct().withColumn("labels", F.split("host", r"\."))
    fits = F.filter(grid, lambda s: (s["n"] <= F.size("labels")) & (s["p"] <= F.length("path")))
    expanded = urls.select("host", "path", "labels", F.explode(fits).alias("s")).select(
        "host", "path",
        F.array_join(F.expr("slice(labels, size(labels) - s.n + 1, s.n)"), ".").alias("e_host"),
        F.expr("substring(path, 1, s.p)").alias("e_path"),
    ).withColumn("e_digest", digest(F.concat("e_host", "e_path"))
                 ).withColumn("prefix", F.substring("e_digest", 1, prefix_hex))
    hits = join_small(expanded, hashed, "prefix", "inner").where(
        (F.col("e_digest") == F.col("r_digest")) & (F.col("e_host") == F.col("r_host"))
        & (F.col("e_path") == F.col("r_path")))
    best = hits.groupBy("host", "path").agg(F.max_by(
        F.struct("rule", "r_verdict"), F.struct(F.length("rule"), F.length("r_host"))).alias("b"))
    found = best.select("host", "path", F.col("b.rule").alias("rule"), F.col("b.r_verdict").alias("verdict"))
    # back by the URL's digest: broadcast when measured small, else a hot URL's pages are salted; pages without a host
    # have a null key and are spread as well
    url = F.when(F.col("host") != "", F.sha2(F.concat_ws("\x00", "host", "path").cast("binary"), 256))
    joined = skew_join(base.withColumn("r_url", url), found.select(url.alias("r_url"), "rule", "verdict"), "r_url")
    return joined.select(id_col, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
