"""URL filters: host-suffix and path-prefix rules looked up by short hash prefixes.

Each distinct (host, path) is expanded into the suffixes of its host (at the dots) that have as many labels as some rule's
host, combined with the prefixes of its path that are as long as some rule's path. Expressions are joined to the rules on the first 8 hex digits of their
SHA-256, an equi-join; the full digest then confirms the match, and of a url's confirmed rules the longest wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX = 8  # hex digits of the digest that are joined on
MOST_LENGTHS = 4096  # different lengths of rules' paths, and of their hosts in labels
DEFAULT = "allow"  # the verdict where no rule fits

HOST = r"""case when url is null or locate('://', url) = 0 then ''
    else translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    end"""
PATH = r"""case when url is null or locate('://', url) = 0 then ''
    else regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) end"""


def split_url(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path`` to ``pages`` (url). Null urls and urls without ``://`` have empty ones.

    Columns named host or path that are there already are replaced.
    """
    return pages.withColumns({"host": F.expr(HOST), "path": F.expr(PATH)})


def prepared(rules: DataFrame) -> DataFrame:
    """(key, digest, rule, length, verdict) of ``rules`` (verdict, host, path); rules with nulls take no part.

    Of several verdicts for the same host and path, block holds.
    """
    return (
        rules.where("verdict is not null and host is not null and path is not null")
        .select(F.lower("host").alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.sha2(F.concat_ws("\n", "host", "path"), 256).alias("digest"),
            F.concat("host", "path").alias("rule"),
            F.struct(F.length(F.concat("host", "path")), F.length("host")).alias("length"),
            "verdict",
        )
        .withColumn("key", F.substring("digest", 1, PREFIX))
    )


def _dots(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))


def _lengths(rules: DataFrame, length: Column) -> list[int]:
    """The different values of ``length`` among the rules."""
    found = rules.where("verdict is not null and host is not null and path is not null").select(length.alias("n")).distinct()
    values = [row.n for row in found.orderBy("n").limit(MOST_LENGTHS + 1).collect()]
    if len(values) > MOST_LENGTHS:
        raise ValueError(f"rules have more than {MOST_LENGTHS} different lengths")
    return values


def _known(values: Iterable[Column]) -> Column:
    return F.filter(F.array(*values), lambda value: value.isNotNull()).cast("array<string>")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url; other columns are ignored).

    A rule fits its host and all subdomains when the path starts with the rule's path; the longest rule (host and path
    together, then the longer host) wins. Without one ``rule`` is null and the verdict ``allow``. Null urls and urls
    without ``://`` have an empty host, which no rule fits unless its own is empty. Null and repeated ids are judged
    row by row. Empty tables are fine on either side. Rules with paths of more than ``MOST_LENGTHS`` different lengths, or hosts
    of so many different numbers of labels, are an error.
    """
    split = split_url(pages.select("page_id", F.col("url").cast("string").alias("url")))
    cuts = _lengths(rules, F.length("path"))
    labels = _lengths(rules, _dots(F.col("host")) + 1)
    # work in proportion to the host's length for each number of labels
    suffixes = _known(F.when(_dots(F.col("host")) + 1 >= n, F.substring_index("host", ".", -n)) for n in labels)
    prefixes = _known(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in cuts)
    distinct = split.select("host", "path").distinct()
    expressions = (
        distinct.select("host", "path", F.explode(prefixes).alias("prefix"), suffixes.alias("suffixes"))
        .select("host", "path", "prefix", F.explode("suffixes").alias("suffix"))
        .select("host", "path", F.sha2(F.concat_ws("\n", "suffix", "prefix"), 256).alias("found"))
        .withColumn("key", F.substring("found", 1, PREFIX))
    )
    best = (
        expressions.join(prepared(rules), "key")
        .where("found = digest")
        .groupBy("host", "path")
        .agg(F.max(F.struct("length", "verdict", "rule")).alias("best"))
        .select(F.col("host").alias("h"), F.col("path").alias("p"), "best.rule", "best.verdict")
    )
    return split.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict")
    )
