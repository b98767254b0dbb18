"""Line dedup: drop the lines that a large part of a site's pages share.

For each host, the pages that contain a line are divided by the pages of the host; lines on at least
min_pages pages and on more than ``percent`` of the host's pages are boilerplate and leave every page
of that host. A page counts once for a line however often it repeats it. Lines are compared without
outer ASCII space, by two 64-bit hashes.

Counting aggregates partially before it shuffles, so a host with a third of all pages is spread over
tasks. The boilerplate of a host is bounded: at most (mean distinct lines of its pages) * 100 / percent lines.
It is written to the shared folder, so Spark knows its size when it picks the join.

Defined results: rows with a null host are kept as they are; a null text stays null; blank lines are
never boilerplate; a text may become empty but its row stays; no rows give no rows. Other columns stay as they
are, whatever their names; n_lines and n_dropped are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import settle

PERCENT = 10
MIN_PAGES = 5
SPACES = " \t\n\x0b\f\r"

_BLOCKS = "p|br|li|div|h[1-6]|tr|td|th|ul|ol|table|article|section|nav|header|footer|aside|main|title|head|body|html|blockquote|pre|form"
SKIPPED = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BREAKS = rf"(?i)</?(?:{_BLOCKS})(?:\s[^>]*)?/?>|[\r\n]+"
TAGS = r"<[^>]*>"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)"


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def page_text(html: Column) -> Column:
    """The text of a page with a line for each block element; tags, scripts, styles and comments go."""
    flat = F.regexp_replace(F.regexp_replace(html, SKIPPED, ""), BREAKS, "\n")
    return F.regexp_replace(flat, TAGS, "")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _mark(line: Column) -> Column:
    return F.struct(F.xxhash64(_trimmed(line)).alias("h"), F.xxhash64(_trimmed(line), F.lit(1)).alias("g"))


def boilerplate(df: DataFrame, host_col: str, text_col: str = "text", percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """_host and _lines: the marks of each host's boilerplate lines."""
    pages = df.select(F.col(host_col).alias("_host"), F.col(text_col).alias("_text")).where("_host is not null")
    totals = pages.groupBy("_host").agg(F.count("*").alias("_pages"))
    lines = F.filter(F.split("_text", "\n"), lambda x: _trimmed(x) != "")
    marks = pages.select("_host", F.explode(F.array_distinct(F.transform(lines, _mark))).alias("_m"))
    counts = marks.groupBy("_host", "_m.h", "_m.g").agg(F.count("*").alias("_n")).where(F.col("_n") >= min_pages)
    shared = counts.join(totals, "_host").where(100 * F.col("_n") > percent * F.col("_pages"))
    return settle(shared.groupBy("_host").agg(F.collect_set(F.struct("h", "g")).alias("_lines")))


def drop_boilerplate(df: DataFrame, host_col: str, text_col: str = "text", percent: int = PERCENT, min_pages: int = MIN_PAGES) -> DataFrame:
    """df with the boilerplate lines gone from text_col, and columns n_lines and n_dropped (non-blank lines)."""
    bad = boilerplate(df, host_col, text_col, percent, min_pages)
    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    # the input's columns go into one struct, so that none clashes with those used here
    rows = df.select(F.struct(*names).alias("row"), F.col(host_col).alias("_own"), F.col(text_col).alias("_text"), F.split(F.col(text_col), "\n").alias("_all"))
    out = rows.join(bad, F.col("_own") == F.col("_host"), "left")
    blank = lambda x: _trimmed(x) == ""
    kept = F.when(F.col("_lines").isNull(), F.col("_all")).otherwise(F.filter("_all", lambda x: blank(x) | ~F.array_contains("_lines", _mark(x))))
    out = out.withColumn("_kept", kept)
    count = lambda c: F.coalesce(F.size(F.filter(c, lambda x: ~blank(x))).cast("long"), F.lit(0).cast("long"))
    n, k = count("_all"), count("_kept")
    text = F.when(F.size("_kept") == F.size("_all"), F.col("_text")).otherwise(F.array_join("_kept", "\n"))
    zero = F.col("_text").isNull()
    cols = [text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names]
    return out.select(*cols, F.when(zero, 0).otherwise(n).cast("long").alias("n_lines"), F.when(zero, 0).otherwise(n - k).cast("long").alias("n_dropped"))


def sql() -> str:
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH p AS (SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
  regexp_replace(regexp_replace(regexp_replace(html, '{SKIPPED}', '', 'g'), '{BREAKS}', chr(10), 'g'), '{TAGS}', '', 'g') AS text FROM pages),
l AS (SELECT page_id, host, unnest(range(len(string_split(text, chr(10))))) AS k, unnest(string_split(text, chr(10))) AS line FROM p),
t AS (SELECT *, trim(line, {spaces}) AS s FROM l),
n AS (SELECT host, count(*) AS pages FROM p WHERE host IS NOT NULL GROUP BY host),
b AS (SELECT t.host, s FROM t JOIN n ON t.host = n.host WHERE s <> '' GROUP BY t.host, s, pages
  HAVING count(DISTINCT page_id) >= {MIN_PAGES} AND 100 * count(DISTINCT page_id) > {PERCENT} * pages),
j AS (SELECT t.*, b.s IS NOT NULL AS bad FROM t LEFT JOIN b ON t.host = b.host AND t.s = b.s),
a AS (SELECT page_id, sum((s <> '')::INT)::BIGINT AS n_lines, sum(bad::INT)::BIGINT AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT bad), '') AS text FROM j GROUP BY page_id)
SELECT p.page_id, p.host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, a.text, sha256(coalesce(a.text, '')) AS kept_sha256
FROM p LEFT JOIN a ON p.page_id = a.page_id"""
