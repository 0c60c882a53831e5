"""Boilerplate lines by their frequency relative to their site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: share of a host's pages from which on a line is boilerplate
RATIO = 0.1
#: hosts with fewer pages have no boilerplate: one page in two is no evidence
MIN_PAGES = 4
#: pages that must hold a line before it is boilerplate, however few pages its host has
SUPPORT = 3
#: pages of a host that one part of it holds where pages meet their host's lines
PART_PAGES = 4096


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1), F.lit("")))


def lines(html: Column) -> Column:
    """The lines of a page: its text with tags as line ends, without scripts, styles and comments, trimmed, none empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"<[^<>]*>", "\n")
    cut = F.transform(F.split(text, r"[\r\n]+"), lambda x: F.regexp_replace(x, r"^[ \t]+|[ \t]+$", ""))
    return F.filter(cut, lambda x: x != "")


def line_dedup(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, support: int = SUPPORT) -> DataFrame:
    """One row per page: ``page_id, host, n_lines, n_dropped, text`` (the lines that stay, in order).

    For each host and line, the pages that hold the line are divided by the host's pages; lines above ``ratio`` go, on
    hosts with at least ``min_pages`` pages, if at least ``support`` pages hold them (else a line of one page would be
    boilerplate on every host with fewer than 1 / ratio pages). Counts run over line hashes, pre-aggregated before they are shuffled, so a
    host with a third of all pages is no hot task. A host has at most (lines of a page) / ratio such lines, as the
    shares of all its lines sum to the lines of a page; they come to its pages as one array. Where the two meet, a host
    with more than PART_PAGES pages is dealt in parts; the list of such hosts, which is broadcast for that, has at most
    pages / PART_PAGES rows.

    Null pages have no lines; pages without a host (null or odd URLs) form one site; repeated rows count as pages.
    A line repeated on a page counts once, and all its places go. An empty table gives no rows; other columns are not
    read.
    """
    cut = pages.select("page_id", host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines"))
    hashed = F.transform("lines", lambda x: F.xxhash64(x))
    totals = cut.groupBy("host").agg(F.count("*").alias("pages"))
    held = cut.select("host", F.explode(F.array_distinct(hashed)).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    common = (
        held.join(totals.where(F.col("pages") >= min_pages), "host")
        .where((F.col("n") > F.lit(ratio) * F.col("pages")) & (F.col("n") >= support))
        .groupBy("host").agg(F.collect_list("line").alias("common"))
    )
    large = F.broadcast(totals.where(F.col("pages") > PART_PAGES).select("host", F.ceil(F.col("pages") / PART_PAGES).alias("parts")))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    dealt = cut.join(large, "host", "left").withColumn("part", F.pmod(F.xxhash64("page_id", "lines"), parts)).drop("parts")
    copied = common.join(large, "host", "left").select("host", "common", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part"))
    joined = dealt.join(copied, ["host", "part"], "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    stay = F.filter("lines", lambda x: ~F.array_contains(F.col("common"), F.xxhash64(x)))
    return joined.withColumn("stay", stay).select(
        "page_id", "host", F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("stay")).cast("bigint").alias("n_dropped"), F.concat_ws("\n", "stay").alias("text"),
    )
