"""Line dedup by site-relative frequency.

Pages are grouped by host.  A line is boilerplate of a host when the pages that
hold it are more than ``ratio`` of all pages of the host, and ``least`` pages at
least.  Boilerplate lines are dropped from every page of the host; the same line
on another host is judged there.

Lines are counted as 64-bit hashes, once per page, partially aggregated before
the shuffle.  What meets the pages again is one row per host: as every page adds
its share to at most its own lines, a host has at most (lines per page / ratio)
boilerplate lines.  The join is Spark's to broadcast by size or to split where
a host is hot.

Defined cases: null html has no lines, an url without host belongs to the host
"" ; empty lines are left out; a script, style, comment or tag that is not closed
hides the rest of its page; a "<" that opens no tag is text; repeated rows count as pages of their own; a host
of fewer than ``least`` pages loses nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import written
from keyfold.llm.op5_url import host_path

RATIO = 0.3
LEAST = 3
#: Markup that holds no text, tags that end a line, entities (fixed patterns).
#: What is opened and not closed reaches to the end of the page, as in browsers: so a
#: match takes in all that it has looked at, and the time grows with the page.
HIDDEN = (r"(?is)<script[^>]*(?:>|\z).*?(?:</script\s*>|\z)|<style[^>]*(?:>|\z).*?(?:</style\s*>|\z)|"
          r"<!--.*?(?:-->|\z)")
BLOCK = (r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|article|section|nav|header|footer|"
         r"title|body|head|html|blockquote|pre)(?:\s[^>]*)?/?(?:>|\z)")
TAG = r"<[A-Za-z/!?][^>]*(?:>|\z)"
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def lines_of(html: Column) -> Column:
    """Array of the text lines of a page, spaces collapsed, empty ones left out."""
    t = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, " ")
    t = F.regexp_replace(F.regexp_replace(t, BLOCK, "\n"), TAG, "")
    for entity, char in ENTITIES:
        t = F.replace(t, F.lit(entity), F.lit(char))
    return plain_lines(t)


def plain_lines(text: Column) -> Column:
    """Array of the lines of a text without markup, likewise."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\f]+", " ")
    return F.filter(F.transform(F.split(t, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def split_lines(pages: DataFrame, page="page_id", url="url", html="html") -> DataFrame:
    """page, host, lines of every page, written once."""
    return written(pages.select(F.col(page).alias("page"), host_path(F.col(url))[0].alias("host"),
                                lines_of(F.col(html)).alias("lines")), "lines-pages")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """host, bad: the hashes of the host's boilerplate lines."""
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    seen = pages.select("host", F.explode(F.array_distinct(
        F.transform("lines", lambda x: F.xxhash64(x)))).alias("line")) \
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    bad = seen.filter(F.col("n") >= least).join(hosts, "host") \
        .filter(F.col("n") > F.col("pages") * ratio)
    return bad.groupBy("host").agg(F.collect_set("line").alias("bad"))


def dedup(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """``pages`` (page, host, lines) without boilerplate: page, host, n_lines,
    n_dropped, lines."""
    # read from a table, the hosts' lines do not tie the pages to their own
    # partitioning, and Spark may split the pages of one host over tasks
    bad = written(boilerplate(pages, ratio, least), "lines-bad")
    own = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains(F.col("bad"), F.xxhash64(x))))
    out = pages.join(bad, "host", "left").select(
        "page", "host", F.size("lines").cast("long").alias("n_lines"), own.alias("lines"))
    return out.select("page", "host", "n_lines",
                      (F.col("n_lines") - F.size("lines")).alias("n_dropped"), "lines")
