"""Line dedup by site-relative frequency, on DataFrame functions alone.

For each host, a line's ratio is the number of pages that contain it over all pages of the host. Lines above a ratio are the site's
boilerplate and go. Pages count a line once. Counting is a two-level aggregate over digests, so a host with a third
of all pages is summed where its rows lie. The ratio decides for hosts of any size, with one exception: a line must be on MIN_PAGES = 2 pages, since on a host
of up to 9 pages every line exceeds a tenth of them. So on a host of fewer than 20 pages, what two of its pages share goes. A host's boilerplate is a short list: at most (mean lines per page / ratio)
lines exceed the ratio. Pages meet it in a join by host: broadcast if its measured size is small, else a shuffle
join, whose hot hosts Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import stored, whole_rows, without

MAX_RATIO = 0.1
#: A line on one page alone repeats nothing. Beyond that, the ratio decides, on hosts of any size.
MIN_PAGES = 2
BROADCAST_BYTES = 8 << 20

_TEMP = ["__host", "__lines", "__drop"]


#: Outer white space that doesn't make lines differ.
BLANKS = " \t\r\x0b\x0c"


def bare_line(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_digest(bare: Column) -> Column:
    return F.unhex(F.md5(bare))


def line_key(line: Column) -> Column:
    """What makes lines equal: the text without outer white space; blank lines have no key."""
    bare = bare_line(line)
    return F.when(bare != "", line_digest(bare))


def boilerplate(pages: DataFrame, host: Column, lines: Column, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per host the array `drop` of keys of its boilerplate lines; hosts without any have no row.

    A line is boilerplate if more than max_ratio of the host's pages contain it, and min_pages at least.
    """
    bare = F.array_distinct(F.filter(F.transform(lines, bare_line), lambda x: x != ""))  # each line is hashed once a page
    sited = pages.select(host.alias("host"), F.transform(bare, line_digest).alias("keys")).where(F.col("host").isNotNull())
    totals = sited.groupBy("host").agg(F.count("*").alias("n_pages"))
    counts = sited.select("host", F.explode("keys").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    return (
        counts.where(F.col("n") >= min_pages)
        .join(totals, "host")
        .where(F.col("n") > F.lit(max_ratio) * F.col("n_pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("drop"))
    )


def split_boilerplate(pages: DataFrame, host: Column, lines: Column, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """pages with kept_lines, the lines that stay in their order, and n_lines, n_dropped, which count non-blank lines.

    Pages without a host have no site to compare with and keep all. Null or empty lines arrays give no lines. Blank lines are never
    boilerplate. Repeated pages count as pages of their own. Columns of pages with the names of results are replaced.
    """
    found = stored(boilerplate(pages, host, lines, max_ratio, min_pages), "boilerplate").withColumnsRenamed({"host": "__host", "drop": "__drop"})
    size = found.agg(F.sum(F.size("__drop") * 24 + F.length("__host") + 32)).first()[0] or 0
    sited = without(pages, "kept_lines", "n_lines", "n_dropped", *_TEMP).withColumns({"__host": host, "__lines": F.coalesce(lines, F.array().cast("array<string>"))})
    joined = sited.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "__host", "left")
    kept = F.when(F.col("__drop").isNull(), F.col("__lines")).otherwise(
        F.filter("__lines", lambda x: ~F.coalesce(F.array_contains("__drop", line_key(x)), F.lit(False)))
    )
    full = lambda c: F.size(F.filter(c, lambda x: bare_line(x) != "")).cast("long")
    return (
        joined.withColumn("kept_lines", kept)
        .withColumns({"n_lines": full("__lines"), "n_dropped": full("__lines") - full("kept_lines")})
        .drop(*_TEMP)
    )


# -- pages and documents ------------------------------------------------------------------------------

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]]*\]|[^/?#:@]+)"
#: One "<" before the choice, so that the search looks at little but the tags. The same holds for the block tags, by their first letters.
UNSEEN = r"(?s)<(?:script.*?</script>|style.*?</style>|!--.*?-->)"
BREAKS = r"</?(address|article|aside|blockquote|body|br|div|dd|dl|dt|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(\s[^>]*)?/?>"
#: What BREAKS, which the SQL check has, finds.
QUICK_BREAKS = (
    r"</?(?:a(?:ddress|rticle|side)|b(?:lockquote|ody|r)|d(?:iv|[dlt])|f(?:ooter|orm)|h(?:[1-6r]|ead(?:er)?|tml)|li|main|nav|ol|p(?:re)?|section"
    r"|t(?:able|itle|[dhr])|ul)(?:\s[^>]*)?/?>"
)
TAG = r"<[^>]*>"


def url_host(url: Column) -> Column:
    """The lower-case host of a URL, without user and port; null if it has none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def html_lines(html: Column) -> Column:
    """Visible text by blocks: scripts, styles and comments go, block tags break lines, other tags vanish; no blank lines."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(html, UNSEEN, ""), QUICK_BREAKS, "\n"), TAG, "")
    return F.filter(F.transform(F.split(text, "\n"), bare_line), lambda x: x != "")


def dedup_pages(pages: DataFrame, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: page_id, host, n_lines, n_dropped and the text that is left."""
    slim = pages.select("page_id", "url", "html")
    out = split_boilerplate(slim, url_host(F.col("url")), html_lines(F.col("html")), max_ratio, min_pages)
    return out.select("page_id", url_host(F.col("url")).alias("host"), "n_lines", "n_dropped", F.array_join("kept_lines", "\n").alias("text"))


def dedup_documents(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """docs with boilerplate lines cut from the text; all rows and columns stay, n_chars follows the text if there is one.

    A null text stays null. A text without boilerplate stays as it is, byte for byte; one of nothing but boilerplate becomes empty.
    """
    rows = whole_rows(docs, F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").alias("text"))
    out = split_boilerplate(rows, F.col("host"), F.split("text", "\n"), max_ratio, min_pages)
    new = {text: F.when(F.col("n_dropped") > 0, F.array_join("kept_lines", "\n")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length(new[text]).cast("long"), F.col("row.n_chars"))
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


PAGES_SQL = rf"""
WITH lined AS (
  SELECT page_id, url, html,
    CASE WHEN regexp_extract(url, '{HOST}', 1) <> '' THEN lower(regexp_extract(url, '{HOST}', 1)) END AS host,
    list_filter(list_transform(string_split(
      regexp_replace(regexp_replace(regexp_replace(html, '<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'gs'),
        '{BREAKS}', chr(10), 'g'), '{TAG}', '', 'g'), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '') AS lines
  FROM pages
), totals AS (
  SELECT host, count(*) AS n_pages FROM lined WHERE host IS NOT NULL GROUP BY host
), counts AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined WHERE host IS NOT NULL) GROUP BY host, line
), boilerplate AS (
  SELECT host, list(line) AS gone FROM counts JOIN totals USING (host)
  WHERE n >= {MIN_PAGES} AND n > {MAX_RATIO} * n_pages GROUP BY host
), kept AS (
  SELECT page_id, l.host, coalesce(lines, []) AS lines,
    list_filter(coalesce(lines, []), lambda x: NOT list_contains(coalesce(gone, []), x)) AS kept
  FROM lined l LEFT JOIN boilerplate b ON l.host = b.host
)
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, coalesce(array_to_string(kept, chr(10)), '') AS text
FROM kept
"""
