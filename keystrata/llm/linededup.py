"""Line dedup (operator 9): lines that recur over a site's pages are boilerplate.

A page's lines are its text between block-level tags, without scripts, styles, comments and
inline tags, trimmed, blank ones left out. Pages are grouped by host; a line contained in more
than `ratio` of a host's pages, in two pages at least, is dropped from all of them.

Lines are counted by (host, 64-bit and 32-bit hash, length), with partial sums before the
shuffle, so a hot host or line costs no task more. At most mean lines / ratio lines a host can
reach the ratio, which bounds a host's list. The lists of all hosts are written first: they are
sent to all executors if their measured size is under `LISTS_BYTES`, else joined to the pages by
host, the pages of a hot host dealt over several tasks.

Edge cases: a script, style or comment that isn't closed goes to the end of its page, so no opening is
looked at twice; a < without > before the next < is text; null html has no lines; a null, relative or odd url has no host, and such pages keep
all lines; a line repeated within a page counts once there; repeated rows are pages each; a
host's only page keeps all lines; empty tables give empty results. Columns of pages named like
the results are replaced, others are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release, spread

LISTS_BYTES = 32 << 20

#: What separates lines, by tag.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul)\b[^<>]*>"
INLINE = r"<[^<>]*>"
BLANK = " \t\n\x0b\x0c\r"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def host(url: Column) -> Column:
    """Lower-case host of an absolute url, null if none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def lines(html: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, HIDDEN, "\n"), BLOCK, "\n"), INLINE, "")
    return F.coalesce(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANK))), lambda x: x != ""), F.array().cast("array<string>"))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"), F.char_length(line).alias("c"))


def without_boilerplate(pages: DataFrame, ratio: float = 0.2) -> DataFrame:
    """page_id, host, host_pages, n_lines, n_dropped, text (kept lines, joined by line feeds)."""
    own = cut(pages.select("page_id", host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines")))
    sited = own.where("host is not null")
    seen = sited.select("host", F.explode(F.array_distinct(F.transform("lines", _key))).alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).where("n > 1")
    sites = cut(sited.groupBy("host").agg(F.count("*").alias("host_pages")))
    often = seen.join(sites, "host").where(F.col("n") > F.col("host_pages") * ratio).groupBy("host").agg(F.collect_list("line").alias("drop"))
    known = cut(sites.join(often, "host", "left"))
    size = known.agg(F.sum(F.octet_length("host") + 64 + 48 * F.greatest(F.size("drop"), F.lit(0)))).first()[0] or 0
    if size <= LISTS_BYTES:
        joined = own.join(F.broadcast(known), "host", "left")
    else:
        joined = spread(own, known, "host", F.monotonically_increasing_id(), sites.select("host", F.col("host_pages").alias("n")), own.count(), how="left")
    release(sites)
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains(F.col("drop"), _key(x))))
    return joined.select("page_id", "host", F.coalesce("host_pages", F.lit(0)).alias("host_pages"), F.size("lines").alias("n_lines"), (F.size("lines") - F.size(kept)).alias("n_dropped"), F.array_join(kept, "\n").alias("text"))
