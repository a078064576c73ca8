"""URL filter lists (operator 7): DataFrame operations only.

Each url is expanded into expressions, a suffix of its host followed by a prefix of its
path. Expressions meet rules on the first four bytes of their SHA-256; the full digests
are then compared, and of the rules that remain the longest decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest on which urls and rules meet.
PREFIX_HEX = 8
#: Rules up to this number (about 200 bytes each) are broadcast; longer lists are joined by shuffle.
BROADCAST_RULES = 100_000


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def _hosts(host: Column) -> Column:
    """The host and what follows each of its dots; no host, no expression."""
    labels = F.split(host, r"\.", -1)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(cuts)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for each row of ``pages`` (``page_id, url``).

    ``rules`` has ``host, path, verdict`` (allow or block); a rule holds for its host and all
    subdomains if the path of the url starts with its path. The longest rule decides (of equal
    length the one with the longer host, then block); without one the verdict is ``default``
    and ``rule`` is null. Null urls, and urls without ``://``, have an empty host and path and
    take the default. Repeated rows stay; other columns of ``pages`` are not carried.
    """
    listed = rules.select(
        F.concat("host", "path").alias("rule"), F.length("host").alias("host_length"), F.length("path").alias("path_length"),
        F.col("verdict").alias("rule_verdict"),
    ).where(F.col("rule").isNotNull()).withColumn("digest", F.sha2("rule", 256))
    listed = listed.groupBy("rule", "digest").agg(
        F.max("host_length").alias("host_length"), F.max("path_length").alias("path_length"), F.max("rule_verdict").alias("rule_verdict"),
    ).withColumn("prefix", F.left("digest", F.lit(PREFIX_HEX)))
    # the few lengths that rule paths have: other prefixes of a path can fit no rule
    facts = listed.agg(F.sort_array(F.collect_set("path_length")).alias("lengths"), F.count(F.lit(1)).alias("n")).first()
    lengths = F.array(*[F.lit(n) for n in facts["lengths"]]).cast("array<int>")

    urls = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("rows"))
    parts = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    suffixes = parts.withColumn("suffix", F.explode_outer(_hosts(F.col("host"))))
    fitting = F.filter(lengths, lambda n: n <= F.length("path"))
    expressions = suffixes.withColumn("cut", F.explode_outer(fitting)).withColumn(
        "digest", F.sha2(F.concat("suffix", F.expr("left(path, cut)")), 256)
    ).withColumn("prefix", F.left("digest", F.lit(PREFIX_HEX)))
    hits = listed.select("prefix", F.col("digest").alias("rule_digest"), "rule", "host_length", "rule_verdict")
    if facts["n"] <= BROADCAST_RULES:
        hits = F.broadcast(hits)
    met = expressions.join(hits, "prefix", "left")
    sure = F.col("rule_digest") == F.col("digest")
    best = F.max(F.when(sure, F.struct(F.length("rule").alias("n"), "host_length", F.col("rule_verdict").alias("v"), "rule"))).alias("best")
    judged = met.groupBy("page_id", "url", "host", "path", "rows").agg(best)
    return judged.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict"),
        F.explode(F.expr("array_repeat(0, cast(rows as int))")).alias("_"),
    ).drop("_")
