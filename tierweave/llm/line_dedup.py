"""Removal of lines that many sites share.

A HyperLogLog sketch of the sites of each line is built per task and merged by aggregation, so a
line on every page costs one sketch per task. Lines whose estimate is near the limit are counted
exactly. Of a line on too many sites the first occurrence (smallest document id, then position)
stays and all others go, so that of whole copies one document keeps its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierweave.session import cut_lineage

#: Relative standard error of a sketch with 2**k registers is about 1.04 / 2**(k/2).
SKETCH_BITS = 12
BLANKS = " \t\r\f\x0b"


def _row_key(id_col: str, text_col: str) -> list[Column]:
    """Ids may repeat, so the text takes part in the key of a row."""
    return [F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_text")]


def document_lines(docs: DataFrame, site_col: str, id_col: str, text_col: str) -> DataFrame:
    """Lines with a visible character: row key, position, 128-bit key of the trimmed line, site."""
    trimmed = F.btrim("line", F.lit(BLANKS))
    site = F.when(F.col(site_col).isNotNull(), F.xxhash64(F.col(site_col)))
    return docs.select(
        *_row_key(id_col, text_col), site.alias("_site"), F.posexplode(F.split(text_col, "\n")).alias("_pos", "line"),
    ).filter(trimmed != "").select(
        "_id", "_text", "_pos", "_site",
        F.xxhash64(trimmed).alias("_h1"), F.xxhash64(F.lit(1), trimmed).alias("_h2"),
    )


def widespread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Keys of lines on at least ``min_sites`` sites, with the occurrence that stays."""
    sketched = lines.groupBy("_h1", "_h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS))).alias("_about"),
        F.min(F.struct("_id", "_text", "_pos")).alias("_stays"),
    )
    # five standard errors to either side, one site at least
    slack = max(1.0, 5 * 1.04 / 2 ** (SKETCH_BITS / 2) * min_sites)
    likely = cut_lineage(sketched.filter(F.col("_about") >= min_sites - slack))
    near = likely.filter(F.col("_about") <= min_sites + slack).select("_h1", "_h2")
    exact = (
        lines.filter(F.col("_site").isNotNull()).select("_h1", "_h2", "_site").distinct()
        .join(near, ["_h1", "_h2"], "left_semi")
        .groupBy("_h1", "_h2").agg(F.count("*").alias("_sites"))
        .filter(F.col("_sites") >= min_sites).select("_h1", "_h2")
    )
    far = likely.filter(F.col("_about") > min_sites + slack).select("_h1", "_h2")
    return likely.join(exact.unionByName(far), ["_h1", "_h2"], "left_semi").select("_h1", "_h2", "_stays")


def without_widespread_lines(
    docs: DataFrame, min_sites: int = 5, site_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The documents with widespread lines taken out of the text, plus ``n_lines``, ``n_removed``.

    Lines are compared without blanks at their ends; lines without a visible character stay. A
    NULL text stays NULL with 0 lines, an empty one has one line. Rows without a site add no
    site but lose the lines too. Repeated rows (same id and text) are treated alike. Columns
    named ``n_lines`` or ``n_removed`` are replaced.
    """
    lines = cut_lineage(document_lines(docs, site_col, id_col, text_col))
    wide = widespread_lines(lines, min_sites)
    here = F.struct("_id", "_text", "_pos")
    gone = (
        lines.join(wide, ["_h1", "_h2"]).filter(~here.eqNullSafe(F.col("_stays")))
        .groupBy("_id", "_text").agg(F.collect_set("_pos").alias("_gone"))
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")  # linear, by hashing
    kept = F.transform(left, lambda i: F.get("_lines", i))
    keyed = docs.select(*docs.columns, *_row_key(id_col, text_col))
    joined = keyed.join(
        gone.hint("shuffle_hash"), keyed["_id"].eqNullSafe(gone["_id"]) & (keyed["_text"] == gone["_text"]), "left",
    ).withColumn("_lines", F.split(text_col, "\n"))
    text = F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    order = [F.col(c) if c != text_col else text.alias(text_col) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(
        *order,
        F.greatest(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
    )


def line_dedup_sql(min_sites: int = 5) -> str:
    blanks = "' ' || chr(9) || chr(13) || chr(12) || chr(11)"
    return f"""
WITH split AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, source, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM split),
keyed AS (SELECT *, trim(line, {blanks}) AS k FROM lines),
wide AS (
  SELECT k, min((doc_id, pos)) AS stays FROM keyed WHERE k <> ''
  GROUP BY k HAVING count(DISTINCT source) >= {min_sites}),
marked AS (
  SELECT l.doc_id, l.pos, l.line, w.k IS NOT NULL AND (l.doc_id, l.pos) <> w.stays AS gone
  FROM keyed l LEFT JOIN wide w ON l.k = w.k),
built AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS cleaned
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(b.n_lines, 0) AS n_lines, coalesce(b.n_removed, 0) AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE md5(b.cleaned) END AS cleaned_md5
FROM documents d LEFT JOIN built b ON d.doc_id = b.doc_id"""
