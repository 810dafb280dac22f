"""Line dedup by site-relative frequency.

Within each host, the pages that contain a line are counted and divided by the host's pages.
A line above the ratio is boilerplate of that host and is dropped from all its pages. Native
DataFrame expressions throughout; lines travel as two hashes, never as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import packed, stage

#: Share of a host's pages above which a line is boilerplate, and the pages it must be on at least.
MAX_RATIO, MIN_PAGES = 0.1, 5

_BLOCK = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|th|thead|title|tr|ul"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Text lines of a raw page: scripts, styles and comments removed, block tags end a line."""
    x = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(?:script\b.*?</script\s*>|style\b.*?</style\s*>|!--.*?-->)", "")
    # single spaces, most of all blanks, are left as they are
    x = F.regexp_replace(x, r" [\t\n\r ]+|[\t\n\r][\t\n\r ]*", " ")
    x = F.regexp_replace(x, rf"(?i)</?(?:{_BLOCK})\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"<[^>]*>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return text_lines(x)


def text_lines(text: Column) -> Column:
    """Lines of a text, split at ``\\n``; null has none."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """96 bits of a trimmed line, as text-free columns."""
    t = F.trim(line)
    return F.struct(F.xxhash64(t).alias("a"), F.hash(t, F.length(t)).alias("b"))


def drop_site_lines(pages: DataFrame, host: Column, lines: Column, max_ratio: float = MAX_RATIO,
                    min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` plus ``_lines`` (kept lines), ``_n_lines`` and ``_n_dropped`` (lines with text).

    Every page counts a line once, whatever its column values; repeated rows are pages of their
    own. Pages with a null host form one group. Blank lines are never counted or dropped. A line
    is boilerplate if more than ``max_ratio`` of the host's pages and at least ``min_pages`` pages
    have it. An empty table gives no rows.

    At most (lines per page / max_ratio) lines of a host can be above the ratio, so each host's
    boilerplate is one short array, joined to the pages by host. Lines below the ratio are left out
    before the arrays are gathered.
    """
    base = pages.withColumn("_host", F.coalesce(F.concat(F.lit("h"), host), F.lit("-")))
    keyed = base.select("_host", F.array_distinct(F.transform(F.filter(lines, lambda l: F.trim(l) != ""), _key)).alias("_keys"))
    # outer: a plain explode infers a filter on the array's size, which parses every page again
    counts = (keyed.select("_host", F.explode_outer("_keys").alias("_key")).where(F.col("_key").isNotNull())
              .groupBy("_host", "_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages))
    totals = stage(base.groupBy("_host").agg(F.count(F.lit(1)).alias("_total")), "site-totals")
    # filtered and staged before it is gathered, so that the join can be split where a host is hot
    # and no task ever gathers more of a host than its boilerplate
    common = stage(counts.join(totals, "_host").where(F.col("_n") > F.lit(max_ratio) * F.col("_total"))
                   .select("_host", "_key"), "site-common")
    # a table of its own: the join below can then be broadcast, or split where a host is hot
    site = stage(common.groupBy("_host").agg(F.collect_list("_key").alias("_boilerplate")), "site-lines")
    joined = base.join(site, "_host", "left").withColumn("_all", lines)
    kept = F.filter("_all", lambda l: (F.trim(l) == "") | ~F.coalesce(F.array_contains("_boilerplate", _key(l)), F.lit(False)))
    full = lambda c: F.size(F.filter(c, lambda l: F.trim(l) != "")).cast("long")
    return (joined.withColumn("_lines", kept).withColumn("_n_lines", full("_all"))
            .withColumn("_n_dropped", F.col("_n_lines") - full("_lines")).drop("_all", "_boilerplate", "_host"))


def dedup_page_lines(pages: DataFrame, **params) -> DataFrame:
    """page_id, url, text (lines left), n_lines, n_dropped of raw ``pages``."""
    lines = F.filter(F.transform(html_lines(F.col("html")), lambda l: F.trim(l)), lambda l: l != "")
    # lines are counted and then dropped: raw pages are parsed once
    parsed = stage(pages.select("page_id", "url", host_of(F.col("url")).alias("_site"), lines.alias("_parsed")), "page-lines")
    out = drop_site_lines(parsed, F.col("_site"), F.col("_parsed"), **params)
    return out.select("page_id", "url", F.array_join("_lines", "\n").alias("text"),
                      F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"))


def dedup_document_lines(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with boilerplate lines of their source removed and ``n_chars`` recounted.

    A null text stays null. All rows are kept, also those whose every line goes.
    """
    row = packed(docs)
    field = F.col("_row").getField
    out = drop_site_lines(row, field("source"), text_lines(field("text")), **params)
    text = F.when(field("text").isNotNull(), F.array_join("_lines", "\n"))
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return out.select(*[new.get(c, field(c).alias(c)) for c in docs.columns])


def op9(pages: DataFrame) -> DataFrame:
    return dedup_page_lines(pages)


#: DuckDB oracle of ``op9``: regular expressions as above, rows numbered so that repeated pages count.
OP9_SQL = rf"""
with p as (
  select row_number() over () as rid, page_id, url,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
    regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g') as x
  from pages),
t as (
  select rid, page_id, url, host,
    replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(regexp_replace(regexp_replace(x, '[\t\n\r ]+', ' ', 'g'),
        '(?i)</?(?:{_BLOCK})\b[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') as x
  from p),
l as (
  select rid, page_id, url, host,
    list_filter(list_transform(string_split(x, chr(10)), lambda s: trim(s)), lambda s: s <> '') as ls
  from t),
n as (select host, count(*) as total from l group by host),
c as (
  select host, line, count(*) as n from (select host, unnest(list_distinct(ls)) as line from l) group by host, line),
b as (
  select c.host, list(line) as lines from c join n on c.host is not distinct from n.host
  where c.n >= {MIN_PAGES} and c.n > {MAX_RATIO} * n.total group by c.host)
select page_id, url, array_to_string(list_filter(ls, lambda s: not list_contains(coalesce(b.lines, []), s)), chr(10)) as text,
  cast(len(ls) as bigint) as n_lines,
  cast(len(ls) - len(list_filter(ls, lambda s: not list_contains(coalesce(b.lines, []), s))) as bigint) as n_dropped
from l left join b on l.host is not distinct from b.host
"""
