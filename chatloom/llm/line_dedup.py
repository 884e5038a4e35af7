"""Line dedup by site-relative frequency.

A line of a page is boilerplate when the share of its host's pages that hold it
exceeds ``RATIO`` and more than one page holds it.  Every host is judged; on one with a
single page no line can be boilerplate.

Lines travel as digests.  Counting is partial per task before any shuffle, on
the key (host, line), so neither a host with a third of all pages nor a line on
all of them gathers in one task.  The boilerplate set is written and joined to
the digests of all lines; what returns to a page is the positions to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.shared import cut

RATIO = 0.15
#: Fixed values, written so that Java's and RE2's regular expressions agree.
HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
BLOCK = r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:[\s/][^>]*)?>"
TAG = r"<[^>]*>"
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """The lower-cased host; empty for a null or unreadable address."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def html_lines(html: Column) -> Column:
    """Visible text between block-level tags, as lines."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "")
    return F.regexp_replace(F.regexp_replace(text, BLOCK, "\n"), TAG, "")


def line_dedup(pages: DataFrame, host: Column, text: Column, id_col: str = "page_id", ratio: float = RATIO) -> DataFrame:
    """One row per input row: id, host, n_lines, n_dropped, kept_text.

    Lines are cut at newlines, trimmed of blanks, empty ones not counted; a line
    counts once a page.  Null hosts are one site, null texts have no lines.
    Repeated rows count as pages and pass through, as do null ids.  Long texts take
    memory and time in proportion to their length.  An empty table gives an empty
    result; other columns are ignored.
    """
    rows = pages.select(pages[id_col].alias("_id"), F.coalesce(host, F.lit("")).alias("_host"), F.coalesce(text, F.lit("")).alias("_text"))
    lines = F.filter(F.transform(F.split("_text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    rows = rows.select("_id", "_host", lines.alias("_lines"))
    # A page is known by its id and its lines, so that repeated ids don't mix.  Written with
    # the digests: beside an explode the hash of all lines would be taken again for each of them.
    rows = rows.withColumn("_page", F.xxhash64(F.transform("_lines", lambda x: F.md5(x))))
    digests = cut(rows.select("_id", "_host", "_page", F.transform("_lines", lambda x: F.md5(x)).alias("_md5")), "line-digests")

    total = digests.groupBy("_host").agg(F.count(F.lit(1)).alias("pages")).filter("pages > 1")
    total = cut(total.select(F.col("_host").alias("_site"), "pages"), "line-hosts")
    held = digests.select("_host", F.explode(F.array_distinct("_md5")).alias("_line")).groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    held = cut(held, "line-counts")
    common = held.join(total, held["_host"] == total["_site"]).filter(F.col("n") > F.lit(ratio) * F.col("pages")).select(F.col("_site"), F.col("_line").alias("_common"))
    common = cut(common, "line-boilerplate")

    each = digests.select("_id", "_host", "_page", F.posexplode("_md5").alias("_at", "_line"))
    hits = each.join(common, (each["_host"] == common["_site"]) & (each["_line"] == common["_common"]))
    hits = cut(hits.groupBy("_id", "_page").agg(F.collect_set("_at").alias("_drop")).select(F.col("_id").alias("_of"), F.col("_page").alias("_its"), "_drop"), "line-drops")
    rows = rows.join(hits, rows["_id"].eqNullSafe(hits["_of"]) & (rows["_page"] == hits["_its"]), "left")
    # The difference goes through a hash set: linear in a page's lines, however many of them are dropped.
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_drop")
    kept = F.when(F.col("_drop").isNull(), F.col("_lines")).otherwise(F.transform(left, lambda i: F.get("_lines", i)))
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept_text"),
    )
