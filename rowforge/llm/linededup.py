"""Removal of lines that many sites share, by HyperLogLog sketches of each line's sites.

A line is a text between line feeds, without blanks around it. For each line hash a sketch of its sites is
merged by aggregation; lines whose estimate is near the threshold get an exact distinct
count. Lines found on at least ``min_sites`` sites are boilerplate and leave every document. A
document without a line of its own is a copy rather than a page with boilerplate: it is left
whole, for near-duplicate removal to decide. With ``max_share`` so is every document in which such
lines make up more than that share of the characters, though it may have lines of its own.

Null texts stay null and empty ones empty; blank lines are never boilerplate. Null sites do not
count. Lines repeated in one document or site count once for it. All other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
BAND = 0.08  # five standard errors of a sketch with 2^12 registers


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Hashes of lines on at least ``min_sites`` sites; ``lines`` has _hash and _site."""
    sketched = lines.groupBy("_hash").agg(F.hll_sketch_agg("_site", F.lit(LG_K)).alias("s"))
    estimate = sketched.select("_hash", F.hll_sketch_estimate("s").alias("n"))
    wide = int(min_sites * BAND) + 1
    sure = estimate.filter(F.col("n") > min_sites + wide).select("_hash")
    near = estimate.filter(F.col("n").between(min_sites - wide, min_sites + wide)).select("_hash")
    pairs = lines.join(near, "_hash", "left_semi").select("_hash", "_site").distinct()
    exact = pairs.groupBy("_hash").agg(F.count("_site").alias("n")).filter(F.col("n") >= min_sites).select("_hash")
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, min_sites: int = 8, max_share: float | None = None, text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` without boilerplate lines, plus n_lines and n_removed."""
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row = F.struct(*others)
    parts = F.split(F.col(text), "\n", -1)
    keyed = docs.select(row.alias("_whole_row"), F.xxhash64(F.col("doc_id"), F.col(text)).alias("_doc"))
    source = docs.select(F.xxhash64(F.col("doc_id"), F.col(text)).alias("_doc"), F.col(site).alias("_site"), F.explode(parts).alias("_line"))
    lines = source.withColumn("_line", F.trim("_line")).filter("_line != ''").select("_doc", "_site", F.xxhash64("_line").alias("_hash"))
    common = spread_lines(lines, min_sites)
    hits = lines.join(common, "_hash", "left_semi").groupBy("_doc").agg(F.collect_set("_hash").alias("_wide_hashes"))
    out = keyed.join(hits, "_doc", "left")
    whole = F.split(F.col(f"_whole_row.`{text}`"), "\n", -1)
    bad = lambda x: F.array_contains(F.col("_wide_hashes"), F.xxhash64(F.trim(x)))
    removed = F.filter(whole, lambda x: (F.trim(x) != "") & bad(x))
    kept = F.filter(whole, lambda x: ~((F.trim(x) != "") & bad(x)))
    chars = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda n, x: n + F.length(F.trim(x)))
    small = chars(removed) < chars(whole) if max_share is None else chars(removed) <= F.lit(max_share) * chars(whole)
    drop = F.col("_wide_hashes").isNotNull() & small
    out = out.withColumn("_drop_wide", F.coalesce(drop, F.lit(False)))
    clean = F.when(F.col("_drop_wide"), F.array_join(kept, "\n")).otherwise(F.col(f"_whole_row.`{text}`"))
    values = [clean.alias(c) if c == text else F.col(f"_whole_row.`{c}`").alias(c) for c in others]
    n_lines = F.coalesce(F.size(F.filter(whole, lambda x: F.trim(x) != "")), F.lit(0))
    return out.select(*values, n_lines.alias("n_lines"), F.when(F.col("_drop_wide"), F.size(removed)).otherwise(0).alias("n_removed"))


def boilerplate_sql(table: str, min_sites: int, max_share: float | None = None) -> str:
    """The same cleaning in SQL, with exact distinct counts, over a view with doc_id, text and source."""
    limit = "< sum" if max_share is None else f"<= {max_share} * sum"
    return f"""
    WITH numbered AS (SELECT row_number() OVER () AS r, * FROM {table}),
    parts AS (SELECT r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
              FROM numbered WHERE text IS NOT NULL),
    spread AS (SELECT trim(line) AS line FROM parts WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {min_sites}),
    marked AS (SELECT p.*, s.line IS NOT NULL AS bad FROM parts p LEFT JOIN spread s ON trim(p.line) = s.line),
    totals AS (SELECT r, count(*) FILTER (trim(line) <> '') AS n_lines, count(*) FILTER (bad) AS n_bad,
                      coalesce(sum(length(trim(line))) FILTER (bad), 0) {limit}(length(trim(line))) AS small,
                      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT bad), '') AS kept FROM marked GROUP BY r)
    SELECT n.doc_id, CASE WHEN t.n_bad > 0 AND t.small THEN t.kept ELSE n.text END AS text, n.lang, n.source, n.n_chars,
           coalesce(t.n_lines, 0)::INTEGER AS n_lines, CASE WHEN t.n_bad > 0 AND t.small THEN t.n_bad ELSE 0 END::INTEGER AS n_removed
    FROM numbered n LEFT JOIN totals t USING (r)"""
