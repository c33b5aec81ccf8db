"""Downsampling of overfull wells: limit, fraction for each well, and a reproducible sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .statistics import quantiles

Setting = bool | int | float


def resolve_settings(threshold: Setting | None, downsample: Setting | None) -> tuple[Setting, Setting]:
    """If only one of the two is given, the other takes its value."""
    if threshold is None and downsample is None:
        return False, False
    return (downsample if threshold is None else threshold), (threshold if downsample is None else downsample)


def downsample_plan(passing: DataFrame, whitelist: DataFrame, total_reads: DataFrame, threshold: Setting, downsample: Setting) -> DataFrame:
    """bc_idx, well, qc_pass_reads, limit (null: none), fraction for every well.

    ``passing``: bc_idx, count of passing reads; ``total_reads``: one row, reads. A fraction is any value strictly between 0
    and 1 that is no boolean.
    """
    wells = whitelist.join(passing, "bc_idx", "left").select("bc_idx", "well", "mask", F.coalesce("count", F.lit(0)).alias("qc_pass_reads"))
    q = quantiles(wells.where(~F.col("mask")), "qc_pass_reads", 0.25, 0.75)
    facts = total_reads.crossJoin(q)  # one row each
    dynamic = F.least(2.75 * F.col("q1") - 1.75 * F.col("q0"), F.col("reads") * F.lit(0.15))
    if threshold is False:
        limit = F.lit(None).cast("long")
    elif threshold is True:
        limit = F.bround(dynamic).cast("long")
    elif 0 < threshold < 1:
        limit = F.bround(F.col("reads") * F.lit(float(threshold))).cast("long")
    else:
        limit = F.lit(int(threshold)).cast("long")
    n = F.col("qc_pass_reads")
    if downsample is False:
        over = F.lit(1.0)
    elif downsample is True:
        over = F.least(F.lit(1.0), F.col("limit") / n)
    elif 0 < downsample < 1:
        over = F.lit(float(downsample))
    else:
        over = F.least(F.lit(1.0), F.lit(float(downsample)) / n)
    fraction = F.when(F.col("mask"), 0.0).when(F.col("limit").isNull() | (n <= F.col("limit")), 1.0).otherwise(over)
    out = wells.crossJoin(F.broadcast(facts)).withColumn("limit", limit)  # one row
    return out.select("bc_idx", "well", "qc_pass_reads", "limit", fraction.alias("fraction"))


def bucket_of(name, seed: int):
    """A number from 0 to 2^28 - 1 for each read name and seed, the same in any partitioning."""
    return F.conv(F.substring(F.md5(F.concat(name, F.lit(f":{seed}"))), 1, 7), 16, 10).cast("long")


def downsample(reads: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """``reads`` with kept: whether a read's name falls below its well's fraction. Failing reads are not kept, nor
    are those of no well: noBC counts as masked."""
    fractions = F.broadcast(plan.select("bc_idx", "fraction"))  # one row a well; plates are small
    met = reads.join(fractions, "bc_idx", "left")
    kept = (F.col("qc") == "PASS") & (bucket_of(F.col("name"), seed) < F.coalesce("fraction", F.lit(0.0)) * float(1 << 28))
    return met.withColumn("kept", kept).drop("fraction")


def downsample_report(sampled: DataFrame, plan: DataFrame, sample: str, seed: int, replicate: str = "") -> DataFrame:
    """What was kept of each well (sample, replicate, bc_idx, well, qc_pass_reads, limit, seed, fraction, out)."""
    out = sampled.where("kept").groupBy("bc_idx").agg(F.count("*").alias("out"))
    met = plan.join(out, "bc_idx", "left")
    return met.select(
        F.lit(sample).alias("sample"), F.lit(replicate).alias("replicate"), "bc_idx", "well", "qc_pass_reads", "limit", F.lit(seed).alias("seed"), "fraction", F.coalesce("out", F.lit(0)).alias("out")
    )


def merge_downsample_reports(reports: DataFrame) -> DataFrame:
    """Replicates of a well in one row: counts summed, other values joined."""
    joined = [F.array_join(F.array_sort(F.collect_list(F.col(c).cast("string"))), "|").alias(c) for c in ("replicate", "limit", "seed", "fraction")]
    return reports.groupBy("sample", "bc_idx", "well").agg(F.sum("qc_pass_reads").alias("qc_pass_reads"), F.sum("out").alias("out"), *joined)


def remove_hits(reads: DataFrame, hits: DataFrame) -> DataFrame:
    """Reads that aligned to no contaminant (``hits``: name)."""
    return reads.join(hits.select("name").distinct(), "name", "left_anti")
