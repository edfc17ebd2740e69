"""Mixing sources to target weights with histograms of hash thresholds; DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteframe.llm.common import fresh_name
from tasteframe.scratch import materialise

#: A hash has LEVELS digits of DIGIT bits; each level refines the boundary cell of the level before.
DIGIT, LEVELS = 12, 3


def hash36(doc_id: str) -> Column:
    """36 bits of the md5 of the id as text (null: of an empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), 1, 9), 16, 10).cast("long")


def source_targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target) of ``sizes`` (source, source_size).

    Sources by code point, null last, weigh 1, 2, 3 and so on in turn and share the sum of all sizes. A target stops at
    ``most`` times its source's size; the excess goes to the others by weight. Sources are ranked by size over weight:
    those before a rank are full, the first rank at which the rest can take its share ends the sharing.
    """
    whole = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    w = (
        sizes.withColumn("weight", ((F.row_number().over(whole) - 1) % 3 + 1).cast("long"))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("rank", F.row_number().over(ranked))
        .withColumn("total", F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("rest", F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("share", (F.col("total") - F.col("full")) / F.col("rest"))
        .withColumn("level", F.min(F.when(F.col("share") <= F.col("ratio"), F.struct("rank", "share"))).over(every)["share"])
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return w.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, most: float = 3.0) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words of each document the mix takes.

    ``size`` counts the words (runs without ASCII white space; null text: 0). A source takes every document as often as
    its target goes into its size, and once more those whose hash lies under a threshold. The threshold comes from sums of
    words per source and hash digit: cells under the budget are in, the boundary cell is split by the next digit,
    nothing is sorted. The last cell is in if the sum then lies nearer to the budget. Documents stay whole; equal ids share
    a hash and so their fate. The result depends on the rows alone. Eager: writes the sizes to the shared folder.
    """
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), hash36("doc_id").alias("hash"))
    sized = materialise(sized, "sizes")
    rows = sized.join(thresholds(sized, most), F.col("source").eqNullSafe(F.col("s")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * _times("hash")).alias("taken"))


def _times(hash_of_id: str) -> Column:
    return F.col("whole") + F.when(F.col(hash_of_id) < F.col("end"), 1).otherwise(0)


def thresholds(sized: DataFrame, most: float = 3.0) -> DataFrame:
    """Of ``sized`` (source, size, hash), a row per source: s, source_size, target, whole (copies of every document) and
    end (hashes below it come once more)."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, most).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = materialise(plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")), "plan")
    # the boundary so far: hashes under it are in; its cell is [start, start + width)
    state = plan.select("source", F.col("budget").alias("left"), F.lit(0).cast("long").alias("start"))
    for level in range(LEVELS):
        width = 1 << (DIGIT * (LEVELS - 1 - level))
        upper = state.select(F.col("source").alias("s"), "left", "start")
        inside = F.col("source").eqNullSafe(F.col("s")) & (F.col("hash") >= F.col("start")) & (F.col("hash") < F.col("start") + width * (1 << DIGIT))
        cells = (
            sized.select("source", "size", "hash").join(upper, inside)
            .groupBy("source", "left", "start", F.expr(f"shiftright(hash, {DIGIT * (LEVELS - 1 - level)})").alias("cell")).agg(F.sum("size").alias("in_cell"))
        )
        upto = Window.partitionBy("source").orderBy("cell")
        crossing = (
            cells.withColumn("sum", F.sum("in_cell").over(upto)).filter("sum > left")
            .groupBy("source").agg(F.min(F.struct("cell", "sum", "in_cell", "left")).alias("c"))
            .select("source", (F.col("c.left") - (F.col("c.sum") - F.col("c.in_cell"))).alias("left"), (F.col("c.cell") * width).alias("start"), F.col("c.in_cell").alias("in_cell"))
        )
        state = materialise(crossing, "boundary")
    # the last cell is one hash: in, if that brings the sum nearer
    ends = state.select(F.col("source").alias("s"), (F.col("start") + F.when(F.col("in_cell") - F.col("left") < F.col("left"), 1).otherwise(0)).alias("end"))
    # a source whose budget is never crossed takes all its documents once more, unless nothing is left to take
    plan = plan.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    plan = plan.select(
        F.col("source").alias("s"), "source_size", "target", "whole",
        F.coalesce("end", F.when(F.col("budget") > 0, F.lit(1 << (DIGIT * LEVELS))).otherwise(F.lit(0))).alias("end"),
    )
    return materialise(plan, "thresholds")


ORACLE = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 9) AS BIGINT) AS hash
    FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3.0::DOUBLE AS cap FROM sources),
ranked AS (
    SELECT *, cap / weight AS ratio, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS rank,
           (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
    FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(share, rank) AS level FROM ranked WHERE share <= ratio),
plan AS (
    SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target,
           CASE WHEN source_size > 0 THEN CAST(floor(least(cap, coalesce(level * weight, cap)) / source_size) AS BIGINT) ELSE 0 END AS whole
    FROM ranked, level),
sums AS (
    SELECT s.source, hash, sum(size) AS here, sum(sum(size)) OVER (PARTITION BY s.source ORDER BY hash) AS upto
    FROM sized s GROUP BY s.source, hash),
cells AS (
    SELECT c.source, hash, target - whole * source_size AS budget, here, upto,
           coalesce(max(CASE WHEN upto > target - whole * source_size THEN 1 ELSE 0 END)
                    OVER (PARTITION BY c.source ORDER BY hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS past
    FROM sums c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source),
extra AS (
    SELECT source, hash, CASE WHEN budget > 0 AND upto <= budget THEN 1
                              WHEN past = 0 AND upto > budget AND upto - budget < budget - (upto - here) THEN 1 ELSE 0 END AS more
    FROM cells)
SELECT doc_id, size, source_size, target, CAST(size * (whole + more) AS BIGINT) AS taken
FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
JOIN extra e ON s.source IS NOT DISTINCT FROM e.source AND s.hash = e.hash
"""


def mixed_documents(docs: DataFrame, most: float = 3.0) -> DataFrame:
    """``docs`` as the mix takes them: each with ``copies`` (1 and up) and ``target_words`` of its source; others are left out.

    Columns of these two names that ``docs`` has are replaced.
    """
    names = [c for c in docs.columns if c not in ("copies", "target_words")]
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    plan = thresholds(materialise(docs.select(F.col("source").cast("string").alias("source"), size.alias("size"), hash36("doc_id").alias("hash")), "sizes"), most)
    held, hash_of = fresh_name(names, "_plan_of_source"), fresh_name(names, "_hash_of_id")
    plan = plan.select(F.struct("*").alias(held))
    plan_of = F.col(held)
    rows = docs.select(*names, hash36("doc_id").alias(hash_of)).join(plan, F.col("source").cast("string").eqNullSafe(plan_of["s"]))
    copies = plan_of["whole"] + F.when(F.col(hash_of) < plan_of["end"], 1).otherwise(0)
    return rows.select(*names, copies.alias("copies"), plan_of["target"].alias("target_words")).filter("copies > 0")
