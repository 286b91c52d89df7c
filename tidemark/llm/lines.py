"""Site-relative line dedup: lines that a large share of one host's pages carry are boilerplate and go.

A line's pages are counted once each, per host; blank lines are kept and never counted. Counting
works on 64-bit line hashes with map-side combine over (host, line), so a hot host is spread over
its lines and a hot line is combined before it moves. A host can have at most
``(lines per page) / max_ratio`` lines above the ratio, however many pages it has, so each host's list
is short. The lists are written to the shared folder, which tells Spark their true size: it
broadcasts them if that is small and otherwise joins by host, where adaptive execution splits a hot host.
The texts are read twice and moved only in that second case. DataFrame functions only.

A line on fewer than ``min_pages`` pages of a host stays, whatever its share: on a host of a few pages every line has a
large share, and would go. 1 turns that off.

Cases: a NULL host is a host of its own; a NULL text has no lines and stays NULL; an empty text is one
blank line; a text whose every line goes becomes empty. Repeated rows count as pages of their own.
Other columns pass through, but for ``n_lines`` and ``n_dropped``, which ``drop_boilerplate`` puts in (``cleaned`` does not);
the working columns have reserved names (``__``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.support import stored

MAX_RATIO = 0.1
MIN_PAGES = 5


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """Lines above the ratio: ``__host``, ``__line`` (hash), pages, host_pages."""
    pages = docs.select(F.col(host).alias("__host"), F.split(text, "\n", -1).alias("lines"))
    keys = F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    counts = (
        pages.select("__host", F.explode(keys).alias("__line"))
        .groupBy("__host", "__line")
        .agg(F.count(F.lit(1)).alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    totals = docs.groupBy(F.col(host).alias("h")).agg(F.count(F.lit(1)).alias("host_pages"))
    return (
        counts.join(totals, F.col("__host").eqNullSafe(F.col("h")))
        .where(F.col("pages") > F.col("host_pages") * F.lit(float(max_ratio)))
        .drop("h")
    )


def _cut(docs: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and the input's lines counted in ``__n_lines``, ``__n_dropped``."""
    listed = stored(
        boilerplate(docs, host, text, max_ratio, min_pages)
        .groupBy(F.col("__host"))
        .agg(F.collect_list("__line").alias("__drop")),
        "boilerplate-lines",
    )
    joined = docs.join(listed, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = F.split(text, "\n", -1)
    kept = F.when(
        F.col("__drop").isNull(), F.col("__lines")
    ).otherwise(F.filter("__lines", lambda x: (F.trim(x) == "") | ~F.array_contains("__drop", F.xxhash64(x))))
    return (
        joined.withColumn("__lines", lines)
        .withColumn("__kept", kept)
        .withColumn(text, F.array_join("__kept", "\n"))
        .withColumn("__n_lines", F.greatest(F.coalesce(F.size("__lines"), F.lit(0)), F.lit(0)).cast("long"))
        .withColumn("__n_dropped", F.greatest(F.size("__lines") - F.size("__kept"), F.lit(0)).cast("long"))
        .drop("__host", "__drop", "__lines", "__kept")
    )


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
                     min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text``, and ``n_lines``, ``n_dropped`` (of the input's lines)."""
    cut = _cut(docs.drop("n_lines", "n_dropped"), host, text, max_ratio, min_pages)
    return cut.withColumnsRenamed({"__n_lines": "n_lines", "__n_dropped": "n_dropped"})


def cleaned(docs: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO,
            min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` with boilerplate lines cut, its own columns and no others; ``n_chars``, where there is one, follows the text."""
    cut = _cut(docs, host, text, max_ratio, min_pages)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("__n_dropped") > 0, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def oracle_sql(max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> str:
    return f"""
WITH p AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, source, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM p),
t AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY source),
b AS (
  SELECT l.source, line FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
  WHERE trim(line) <> '' GROUP BY l.source, line
  HAVING count(DISTINCT doc_id) >= {min_pages} AND count(DISTINCT doc_id) > max(host_pages) * CAST({max_ratio} AS DOUBLE)
),
k AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY i) FILTER (WHERE b.line IS NULL) AS kept,
         count(*) AS n, count(b.line) AS dropped
  FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.line = b.line GROUP BY l.doc_id
)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text,
       CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(dropped, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id
"""
