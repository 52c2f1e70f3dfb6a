"""Line dedup by the frequency of a line on its site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitsync.llm.staging import stage

#: Tags that end a line of text.
BLOCK = "p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|article|section|nav|header|footer|title|head|body|html|blockquote|pre|main|aside|form"
HIDDEN = r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->"
#: Entities that are resolved, the ampersand last.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host(url: Column) -> Column:
    """The host of a URL in lower case; empty for null or what is no URL."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), HOST, 1)


def lines(html: Column) -> Column:
    """The non-blank lines of text of a page, trimmed; block tags end lines."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN, "\n")
    text = F.regexp_replace(text, rf"(?i)</?({BLOCK})\b[^>]*>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    split = F.split(text, r"[ \t\r\f]*\n[ \t\r\f\n]*")
    return F.filter(F.transform(split, lambda x: F.btrim(x, F.lit(" \t\r\f"))), lambda x: x != "")


def drop_site_lines(pages: DataFrame, max_ratio: float = 0.1, min_pages: int = 3) -> DataFrame:
    """Pages without the boilerplate of their site: page_id, host, n_lines, n_dropped, text.

    A line is boilerplate on its host if the share of the host's pages that contain it is
    above ``max_ratio`` and at least ``min_pages`` pages do, so that a site of one page
    keeps its text. A page counts once however often it repeats a line; ``text`` is its
    other lines, joined by newlines.

    Pages of null URLs, or ones without a host, form the site ''. A null page has no
    lines and counts as a page. Rows repeated with one page_id are pages of their own. An
    empty table gives an empty result; other columns are not looked at.

    A line is known by its MD5. Counts combine before they are shuffled, so a line or a
    host that a third of all rows share arrives as one row per task. A host's boilerplate
    lines number at most its lines per page over ``max_ratio``; they meet its pages in a
    join whose hot side Spark splits.
    """
    # written, as it is read twice and the HTML is what costs
    read = stage(pages.select("page_id", host(F.col("url")).alias("host"), lines(F.col("html")).alias("lines")), "lines")
    named = read.select("host", F.transform("lines", lambda x: F.md5(x)).alias("ids"))
    # an entry without a line counts the pages
    counted = named.select("host", F.explode_outer(F.concat(F.array(F.lit("")), F.array_distinct("ids"))).alias("id"))
    counts = stage(counted.groupBy("host", "id").agg(F.count("*").alias("n")).where(F.expr(f"id = '' OR n >= {int(min_pages)}")), "line-counts")
    total = counts.where("id = ''").select(F.col("host").alias("h"), F.col("n").alias("pages"))
    common = counts.where("id != ''").join(total, F.col("host") == F.col("h")).where(F.col("n") / F.col("pages") > max_ratio)
    common = stage(common.groupBy("h").agg(F.collect_list("id").alias("drop")), "boilerplate")
    joined = read.join(common, F.col("host") == F.col("h"), "left")
    keep = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("drop", F.md5(x))))
    return joined.select("page_id", "host", "lines", keep.alias("kept")).select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )
