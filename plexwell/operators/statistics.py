"""Counts of demultiplexed reads, lane merging, and the heuristics over wells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality_control import REASONS


def with_no_barcode(whitelist: DataFrame) -> DataFrame:
    """Wells (bc_idx, well, mask) and the one that stands for unmatched reads (-1, noBC)."""
    none = whitelist.sparkSession.createDataFrame([(-1, "noBC", False)], "bc_idx int, well string, mask boolean")
    return whitelist.select(F.col("bc_idx").cast("int").alias("bc_idx"), "well", "mask").unionByName(none)


def total_reads(reads: DataFrame) -> DataFrame:
    return reads.agg(F.count("*").alias("reads"))


def well_counts(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """bc_idx, well, count for every well and noBC; 0 for wells without reads."""
    counts = reads.groupBy("bc_idx").agg(F.count("*").alias("n"))
    return with_no_barcode(whitelist).join(counts, "bc_idx", "left").select("bc_idx", "well", F.coalesce("n", F.lit(0)).alias("count"))


def mismatch_histogram(reads: DataFrame, whitelist: DataFrame, mismatch: int) -> DataFrame:
    """bc_idx, well and a column mm_k for each number of mismatches, over matched reads."""
    wide = reads.where("bc_idx >= 0").groupBy("bc_idx").pivot("bm", list(range(mismatch + 1))).count()
    wells = whitelist.select("bc_idx", "well")
    return wells.join(wide, "bc_idx", "left").select("bc_idx", "well", *(F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(f"mm_{k}") for k in range(mismatch + 1)))


def reason_histogram(reads: DataFrame, whitelist: DataFrame) -> DataFrame:
    """bc_idx, well and a column for each outcome, noBC included."""
    wide = reads.groupBy("bc_idx").pivot("qc", list(REASONS)).count()
    return with_no_barcode(whitelist).join(wide, "bc_idx", "left").select("bc_idx", "well", *(F.coalesce(r, F.lit(0)).alias(r) for r in REASONS))


def task_counts(reads: DataFrame, wells: int, split: int) -> DataFrame:
    """task, count: reads by output part; the last part (``split``) is noBC's."""
    task = F.when(F.col("bc_idx") < 0, split).otherwise(F.floor(F.col("bc_idx") * split / wells)).cast("int")
    return reads.groupBy(task.alias("task")).agg(F.count("*").alias("count"))


def unmatched_counts(reads: DataFrame) -> DataFrame:
    """seq, count of barcodes that matched no well, most frequent last as reports have them."""
    return reads.where("bc_idx < 0").groupBy(F.col("bcseq").alias("seq")).agg(F.count("*").alias("count")).orderBy("count", "seq")


def merge_lanes(*lanes: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Sums over lanes of the same kind of counts; keys that one lane lacks count 0 there."""
    rows = lanes[0]
    for x in lanes[1:]:
        rows = rows.unionByName(x)
    return rows.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values))


def quantiles(values: DataFrame, column: str, *probabilities: float) -> DataFrame:
    """One row of linearly interpolated quantiles q0, q1 ..."""
    return values.agg(*(F.percentile(column, p).alias(f"q{k}") for k, p in enumerate(probabilities)))


def iqr_outliers(counts: DataFrame, whitelist: DataFrame, factor: float = 1.75) -> DataFrame:
    """Unmasked wells whose count exceeds Q3 + factor * (Q3 - Q1); noBC takes no part."""
    own = counts.join(whitelist.where(~F.col("mask")).select("well"), "well")
    limit = quantiles(own, "count", 0.25, 0.75).select((F.col("q1") + factor * (F.col("q1") - F.col("q0"))).alias("limit"))
    return own.crossJoin(F.broadcast(limit)).where(F.col("count") > F.col("limit")).select("well", "count", "limit")  # one row


def fraction_outliers(counts: DataFrame, whitelist: DataFrame, fraction: float = 0.15) -> DataFrame:
    """Wells (noBC among them) with more than ``fraction`` of all reads outside masked wells."""
    own = counts.join(whitelist.where("mask").select("well"), "well", "left_anti")
    limit = own.agg((F.sum("count") * fraction).alias("limit"))
    return own.crossJoin(F.broadcast(limit)).where(F.col("count") > F.col("limit")).select("well", "count", "limit")  # one row


def failed_wells(reasons: DataFrame, whitelist: DataFrame, fraction: float = 0.5) -> DataFrame:
    """Unmasked wells and noBC of whose reads fewer than ``fraction`` passed."""
    total = sum((F.col(r) for r in REASONS[1:]), F.col(REASONS[0]))
    own = reasons.join(whitelist.where("mask").select("well"), "well", "left_anti")
    return own.withColumn("count", total).where(F.col("PASS") < fraction * F.col("count")).select("well", "PASS", "count")


def enforce(failures: DataFrame, name: str, policy: str) -> str:
    """What a heuristic says: "" if it found nothing or policy is ignore; an error if policy is raise."""
    if policy not in ("ignore", "warn", "raise"):
        raise ValueError(f"unknown policy {policy}")
    wells = [] if policy == "ignore" else sorted(r["well"] for r in failures.select("well").collect())  # wells of one plate
    said = f"{name}: {', '.join(wells)}" if wells else ""
    if said and policy == "raise":
        raise ValueError(said)
    return said


def demux_json(reads: DataFrame, whitelist: DataFrame, mismatch: int) -> DataFrame:
    """One row with all counts as JSON text in a fixed order of keys."""
    wells = F.map_from_entries(F.array_sort(F.collect_list(F.struct("well", "count"))))
    per_well = well_counts(reads, whitelist).agg(wells.alias("well_counts"), F.sum("count").alias("read_count"))
    reasons = reason_histogram(reads, whitelist)
    fails = reasons.agg(F.struct(*(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("well"), F.col(r).alias("n"))))).alias(r) for r in REASONS)).alias("fail_counts"))
    hist = mismatch_histogram(reads, whitelist, mismatch).agg(
        F.array(*(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("well"), F.col(f"mm_{k}").alias("n"))))) for k in range(mismatch + 1))).alias("mismatch_counts")
    )
    all_ = per_well.crossJoin(hist).crossJoin(fails)  # one row each
    return all_.select(F.to_json(F.struct("read_count", "well_counts", "mismatch_counts", "fail_counts")).alias("value"))
