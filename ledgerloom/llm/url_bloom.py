"""URL filter: a blocked Bloom filter of the listed canonical URLs, then an exact hash join. Built-ins only.

A listed URL is a host and the start of a path; it holds for the host, its subdomains and all paths that start so.
Each distinct (host, path) asks for every listed shape it could match (a host suffix and a path length in use). The
Bloom filter, whose size is bounded whatever the list, passes possible hits only; the join with the list removes
false positives, and the longest listed URL wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bloom import WORDS, bloom_blocks, possible

def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? or #. Both are
    empty where the url is null or has no ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame, listed: DataFrame, default: str = "allow", bits_per_url: int = 16, max_blocks: int = 1 << 16
) -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of `pages` (page_id, url).

    `listed`: (host, path, verdict). The longest listed URL that fits decides, by the length of host and path
    together; of equal ones the smaller verdict, so that allow precedes block. Without one, rule is null and the
    verdict `default`. Null urls and urls without :// have an empty host and path and fit nothing. Rows with null or
    repeated page_id are judged like any other; other columns are ignored; listed rows with a null are left out. The
    Bloom filter has `bits_per_url` bits per listed URL, and 64 bytes times `max_blocks` at most: beyond that only
    more false positives reach the join. It is the only thing that is broadcast.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule = F.concat("host", "path")
    rules = listed.select(F.lower("host").alias("host"), "path", "verdict").where("host <> '' and path is not null and verdict is not null")
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
    rules = rules.select(F.concat("host", F.lit("\n"), "path").alias("key"), rule.alias("rule"), F.char_length("path").alias("path_length"), "verdict")
    facts = rules.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("path_length")).alias("lengths")).first()
    blocks = max(1, min(max_blocks, -(-facts["n"] * bits_per_url // (64 * WORDS))))
    lengths = facts["lengths"]  # of listed paths; as many as there are lengths of URLs

    urls = rows.select("host", "path").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("path"))
    asked = urls.where("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix"), starts.alias("starts"))
    asked = asked.select("host", "path", "suffix", F.explode("starts").alias("n")).where("suffix <> ''")
    asked = asked.select("host", "path", F.concat("suffix", F.lit("\n"), F.expr("substring(path, 1, n)")).alias("key"))

    asked = possible(asked, F.col("key"), bloom_blocks(rules, F.col("key"), blocks), blocks)
    hits = asked.join(rules, "key")
    order = F.min(F.struct((-F.char_length("rule")).alias("n"), F.col("verdict"), F.col("rule")))
    won = hits.groupBy("host", "path").agg(order.alias("won")).select("host", "path", "won.rule", "won.verdict")
    judged = rows.join(won, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
