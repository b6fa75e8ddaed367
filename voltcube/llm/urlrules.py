"""Operator 13: URL filter rules through hashed host-suffix and path-prefix expressions.

1. A URL's host ends and path starts are its expressions: the host's last k labels and the path's first
   m characters, for the shapes (k, m) that some rule has (no other expression could equal a rule's).
2. Expressions are hashed (SHA-256) and joined with the rules on the first four bytes alone.
3. The full digests decide which pairs are matches; of a URL's rules the longest wins.

The rules are broadcast where they are few (``BROADCAST``, counted); otherwise the expressions meet
them by a shuffle, salted, so that a host of a third of all URLs is spread over ``SALTS`` tasks.
Only matches are grouped, by a number that each row was given before; each row has few.

Host: from the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there to ``?``,
``#`` or the end. A rule fits its host and all subdomains if the URL's path starts with the rule's
(an empty path does not start with ``/``). The longest is the one of most characters, host
and path together; of equal ones that with the longer host, then block before allow.

Defined results: a null URL or one without ``://`` has an empty host and path and matches nothing; URLs that
match nothing are allowed (``DEFAULT``); ports and user names belong to the host; rows repeating an id or a URL are
judged each; rules repeating an expression count once, as block if any of them blocks; rules with a null or empty
host fit nothing; an empty table gives an empty result. Extra columns are carried; result columns replace
input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltcube.llm.common import cut, fresh

BLOCK, ALLOW = "block", "allow"
DEFAULT = ALLOW
#: Rules that are broadcast at most (about 100 bytes each), and salts of the join beyond.
BROADCAST, SALTS = 100_000, 32
#: Bytes of a digest that the join compares.
PREFIX = 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RESULT = ("host", "path", "rule", "verdict")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"\A(?s:.*?)://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def labels(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


def digest(host: Column, path: Column) -> Column:
    # No host holds a slash, so the two parts cannot run into each other in two ways.
    return F.unhex(F.sha2(F.concat(host, F.lit("/"), path).cast("binary"), 256))


def rule_table(rules: DataFrame) -> DataFrame:
    """(prefix, digest, size, host_size, verdict, rule, k, m) of rules (host, path, verdict)."""
    r = rules.select(F.translate("host", _UPPER, _LOWER).alias("h"), F.coalesce("path", F.lit("")).alias("p"), "verdict").filter("length(h) > 0")
    r = r.groupBy("h", "p").agg(F.max("verdict").alias("verdict"))          # 'block' is after 'allow'
    d = digest(F.col("h"), F.col("p"))
    return r.select(F.substring(d, 1, PREFIX).alias("prefix"), d.alias("digest"), F.length(F.concat("h", "p")).alias("size"), F.length("h").alias("host_size"),
                    "verdict", F.concat("h", "p").alias("rule"), labels(F.col("h")).alias("k"), F.length("p").alias("m"))


def expressions(rows: DataFrame, shapes: Sequence[tuple[int, int]], *carried: str) -> DataFrame:
    """(carried, prefix, digest): one row per expression of a URL that has one of the shapes."""
    if not shapes:
        return rows.select(*carried, F.lit(b"").alias("prefix"), F.lit(b"").alias("digest")).limit(0)
    host, path = F.col("host"), F.col("path")
    given = F.array(*[F.when((labels(host) >= k) & (F.length(path) >= m), digest(F.substring_index(host, ".", -k), F.substring(path, 1, m))) for k, m in shapes])
    out = rows.select(*carried, F.explode(F.array_compact(given)).alias("digest"))
    return out.withColumn("prefix", F.substring("digest", 1, PREFIX))


def matches(urls: DataFrame, rules: DataFrame, row: str) -> DataFrame:
    """(row, rule, verdict): the winning rule of each row that has one."""
    rules, _ = cut(rules.sparkSession, rule_table(rules), "url-rules")
    # Shapes come from the rules' texts: at most their longest host in labels times their longest path.
    shapes = sorted((r.k, r.m) for r in rules.select("k", "m").distinct().collect())
    found = expressions(urls, shapes, row)
    side = rules.select(F.col("prefix").alias("rule_prefix"), F.col("digest").alias("rule_digest"), "size", "host_size", "verdict", "rule")
    if rules.count() <= BROADCAST:
        joined = found.join(F.broadcast(side), F.col("prefix") == F.col("rule_prefix"))
    else:
        found = found.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
        side = side.withColumn("rule_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = found.join(side, (F.col("prefix") == F.col("rule_prefix")) & (F.col("salt") == F.col("rule_salt")))
    joined = joined.filter(F.col("digest") == F.col("rule_digest"))
    best = F.max(F.struct("size", "host_size", "verdict", "rule")).alias("best")
    return joined.groupBy(row).agg(best).select(row, "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule (its text; null where none fits) and verdict."""
    spark = pages.sparkSession
    (row, hit) = fresh(pages, "_row", "_hit")
    address = F.col(url)
    kept = [c for c in pages.columns if c.lower() not in RESULT]
    parsed = pages.select(*kept, host_of(address).alias("host"), path_of(address).alias("path"), F.monotonically_increasing_id().alias(row))
    # The numbers hold only once they are written: a task that runs again may see its rows in another order.
    parsed, _ = cut(spark, parsed, "url-rows")
    won = matches(parsed, rules, row).withColumnRenamed(row, hit)
    # Matches grow with the input, so the plan is the same at every size: no broadcast.
    out = parsed.join(won.hint("merge"), F.col(row) == F.col(hit), "left")
    return out.select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
