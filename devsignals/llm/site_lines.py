"""Line deduplication by site-relative frequency.

Pages are grouped by host, those with the same set of lines being one page, so that a group of copies does not turn its own
text into boilerplate. A line's share is the number of the host's pages that hold it, divided by all pages of the host. Lines above `max_share` on at least `min_pages` pages are
boilerplate and go from every page of that host; the page keeps its other lines in order.

One pass takes each page's distinct line hashes and writes them (narrow) to the shared folder; counts
are sums combined before their shuffle. Frequent lines are joined back to those hashes, and only
the lists of lines to drop meet the texts. Pages without such a line keep their text byte for byte.

Defined cases: a null text stays null, an empty one empty; empty lines are never dropped. A null host
is a host of its own. Lines equal up to case and runs of white space are one line. Repeated rows
are one page, and each is cleaned. A page that loses every line becomes the empty text, its row stays. Ties: a share equal
to `max_share` stays. Extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from devsignals.llm.common import row_key
from devsignals.llm.line_counts import line_hash, lines_of, pages_per_line
from devsignals.session import written

MAX_SHARE = 0.1
MIN_PAGES = 5


def boilerplate(pages: DataFrame, max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """Host, line hash, page counts and share of the lines above the limit. `pages`: (host, lines)."""
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("host_pages"))
    lines = pages_per_line(pages).where(F.col("n_pages") >= min_pages)
    return (lines.join(totals, F.col("host").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("share", F.col("n_pages") / F.col("host_pages"))
            .where(F.col("share") > max_share))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """host, lines: of a host's pages with the same set of lines, one."""
    own = F.array_sort("lines")
    return (pages.groupBy("host", F.xxhash64(own).alias("c1"), F.xxhash64(F.lit(7), F.reverse(own)).alias("c2"))
            .agg(F.first("lines").alias("lines")).select("host", "lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text",
                     max_share: float = MAX_SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """The documents with their text less boilerplate lines, and `lines_dropped` (how many)."""
    columns = docs.columns
    inner = docs.select(F.struct(*columns).alias("row"), F.col(host).cast("string").alias("host"), F.col(text).alias("text"),
                        *row_key(*[c for c in columns if dict(docs.dtypes)[c] in ("bigint", "int", "string")]))
    lines = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_hash), lambda x: x.isNotNull()))
    pages = written(inner.select("k1", "k2", "host", lines.alias("lines")), "site-lines")
    frequent = boilerplate(distinct_pages(pages), max_share, min_pages).select("host", "line")
    hits = (pages.select("k1", "k2", "host", F.explode("lines").alias("line")).alias("p")
            .join(frequent.alias("f"), (F.col("p.line") == F.col("f.line")) & F.col("p.host").eqNullSafe(F.col("f.host")))
            .groupBy("p.k1", "p.k2").agg(F.collect_set("p.line").alias("drop")))
    all_lines = lines_of(F.col("text"))
    kept = F.filter(all_lines, lambda x: ~F.coalesce(F.array_contains(F.col("drop"), line_hash(x)), F.lit(False)))
    found = F.col("drop").isNotNull()
    out = inner.join(hits, ["k1", "k2"], "left").withColumn("kept", F.when(found, kept))
    return out.select(
        *[F.when(found, F.array_join("kept", "\n")).otherwise(F.col("text")).alias(c) if c == text else F.col(f"row.{c}")
          for c in columns if c != "lines_dropped"],
        F.when(found, F.size(all_lines) - F.size("kept")).otherwise(0).cast("long").alias("lines_dropped"))


def query(docs: DataFrame) -> DataFrame:
    return drop_boilerplate(docs.select("doc_id", "text", "source")).select(
        "doc_id", F.col("text"), "lines_dropped")


def without_boilerplate(docs: DataFrame) -> DataFrame:
    """Stage: the documents' columns, with shorter texts and their length."""
    out = drop_boilerplate(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("lines_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


SQL = """
WITH lines AS (
    SELECT doc_id, source, i, l, trim(regexp_replace(lower(l), '[\\x09-\\x0D\\x20]+', ' ', 'g')) AS form
    FROM (SELECT doc_id, source, ls[i] AS l, i FROM (
        SELECT doc_id, source, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)))),
pages AS (SELECT DISTINCT source, forms FROM (
    SELECT doc_id, source, list_sort(list_distinct(list_filter(list(form), lambda x: x <> ''))) AS forms FROM lines GROUP BY doc_id, source)),
totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source),
frequent AS (
    SELECT p.source, form FROM (SELECT source, unnest(forms) AS form FROM pages) p JOIN totals t ON p.source IS NOT DISTINCT FROM t.source
    GROUP BY p.source, form, t.n HAVING count(*) >= 5 AND count(*)::DOUBLE / t.n > 0.1),
marked AS (
    SELECT l.doc_id, l.i, l.l, f.form IS NOT NULL AS bad
    FROM lines l LEFT JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.form = f.form)
SELECT doc_id, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE NOT bad), '') AS text,
    count(*) FILTER (WHERE bad) AS lines_dropped
FROM marked GROUP BY doc_id
"""
