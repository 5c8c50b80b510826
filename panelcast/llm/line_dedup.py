"""Line deduplication by site-relative frequency.

A line is boilerplate of its host when at least ``ratio`` of the host's pages
contain it (and at least ``MIN_COPIES`` pages do, of a host with at least
``MIN_PAGES``). Lines are compared without white space at their ends; blank
lines are neither counted nor dropped.

Each page sends every distinct line once, as (host, hash); counts are combined
before the shuffle. A host's boilerplate is short by construction (at most its
mean number of distinct lines per page divided by ``ratio``), so it travels to
the pages as one array per host. Hosts with more than a thousandth of all
pages are served by a broadcast of at most a thousand such arrays; the others
by a shuffle join.

Defined results: null text stays null and counts as a page without lines; a
page without host is left as it is; a text all of whose lines are boilerplate
becomes empty; repeated rows are pages of their own; lines with equal 64-bit
hashes count as equal; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.skew import lookup

RATIO = 0.2
MIN_COPIES = 3
MIN_PAGES = 10
_BLANK = " \t\n\x0b\f\r"


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_BLANK)))


def visible_lines(html: Column) -> Column:
    """Text of a page: scripts, styles and comments go, and every tag ends a
    line."""
    x = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", "\n")
    x = F.regexp_replace(x, r"(?s)<!--.*?-->", "\n")
    return F.regexp_replace(x, r"<[^>]*>", "\n")


def host(url: Column) -> Column:
    """Host name of a URL in lower case (null if there is none)."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def boilerplate(pages: DataFrame, ratio: float = RATIO, min_copies: int = MIN_COPIES, min_pages: int = MIN_PAGES) -> tuple[DataFrame, int]:
    """(host, n_pages, lines) for every host (lines null: no boilerplate), and
    the number of all pages. ``pages``: host, text."""
    totals = pages.where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    total = totals.agg(F.coalesce(F.sum("n_pages"), F.lit(0))).first()[0]
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")
    once = pages.where(F.col("host").isNotNull()).select("host", F.explode(F.array_distinct(F.transform(lines, _line_hash))).alias("line"))
    counts = once.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_copies)
    known = lookup(counts, totals.withColumn("weight", F.col("n_pages")), "host", "weight", F.col("line"), total)
    found = known.where((F.col("n_pages") >= min_pages) & (F.col("n") >= ratio * F.col("n_pages")))
    lists = found.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    return totals.join(lists, "host", "left"), total


def mark(pages: DataFrame, id_col: str, host_col: Column, text_col: Column, **kw) -> DataFrame:
    """id, host, text, n_lines (not blank), n_dropped and kept (the text
    without boilerplate lines)."""
    rows = pages.select(F.col(id_col).alias("id"), host_col.alias("host"), text_col.alias("text"))
    return _apply(rows, F.xxhash64(F.col("id").cast("string"), F.col("text")), **kw)


def _apply(rows: DataFrame, row_id: Column, **kw) -> DataFrame:
    found, total = boilerplate(rows.select("host", "text"), **kw)
    joined = lookup(rows, found, "host", "n_pages", row_id, total)
    lines = F.split("text", "\n")
    is_blank = lambda x: F.btrim(x, F.lit(_BLANK)) == ""
    bad = lambda x: ~is_blank(x) & F.array_contains("lines", _line_hash(x))
    dropped = F.when(F.col("lines").isNull() | F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.filter(lines, bad)))
    kept = F.when(dropped == 0, F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x: ~bad(x)), "\n"))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.filter(lines, lambda x: ~is_blank(x))))
    return joined.select(*rows.columns, n_lines.cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"), kept.alias("kept"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", size_col: str | None = "n_chars", **kw) -> DataFrame:
    """``docs`` without boilerplate lines, all other columns as they were;
    ``size_col``, if there is one, is the new number of characters of changed
    texts."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    of = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = plain.withColumnRenamed(of[text_col], "text").withColumn("host", F.col(of[host_col]).cast("string"))
    out = _apply(rows, F.xxhash64("text", *(c for c in plain.columns if c != of[text_col])), **kw)
    columns = []
    for name, c in of.items():
        value = F.col("kept") if name == text_col else F.col(c)
        if name == size_col and name != text_col:
            value = F.when(F.col("n_dropped") > 0, F.length("kept").cast(dict(docs.dtypes)[name])).otherwise(F.col(c))
        columns.append(value.alias(c))
    return out.select(*columns).toDF(*docs.columns)


def brute_force(pages: list[tuple], ratio: float = RATIO, min_copies: int = MIN_COPIES, min_pages: int = MIN_PAGES) -> list[tuple]:
    """(id, host, n_lines, n_dropped, kept) from small lists of (id, host, text)."""
    total: dict = {}
    seen: dict = {}
    for _, h, t in pages:
        if h is not None:
            total[h] = total.get(h, 0) + 1
            for x in {x.strip(_BLANK) for x in (t or "").split("\n")} - {""}:
                seen[h, x] = seen.get((h, x), 0) + 1
    bad = {k for k, n in seen.items() if n >= min_copies and total[k[0]] >= min_pages and n >= ratio * total[k[0]]}
    out = []
    for i, h, t in pages:
        lines = (t or "").split("\n")
        kept = [x for x in lines if (h, x.strip(_BLANK)) not in bad]
        out.append((i, h, sum(x.strip(_BLANK) != "" for x in lines), len(lines) - len(kept),
                    None if t is None else "\n".join(kept)))
    return out


SQL = r"""
WITH p AS (SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
                  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', chr(10), 'g'),
                                                '(?s)<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g') AS text FROM pages),
l AS (SELECT page_id, host, line, row_number() OVER (PARTITION BY page_id) AS dummy, pos,
             trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
      FROM (SELECT page_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM p)),
t AS (SELECT host, count(*) AS n_pages FROM p WHERE host IS NOT NULL GROUP BY host),
b AS (SELECT host, bare FROM l JOIN t USING (host) WHERE bare <> '' GROUP BY host, bare
      HAVING count(DISTINCT page_id) >= 3 AND max(n_pages) >= 10 AND count(DISTINCT page_id) >= 0.2 * max(n_pages)),
k AS (SELECT l.*, b.bare IS NOT NULL AS bad FROM l LEFT JOIN b ON l.host = b.host AND l.bare = b.bare)
SELECT page_id, max(host) AS host, count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE bad) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '') AS kept
FROM k GROUP BY page_id
"""
