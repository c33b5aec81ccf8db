"""Reports of wells: losses from step to step, and merged parts of other reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _loss(before: Column, after: Column) -> Column:
    return F.try_divide((before - after) * 100.0, before)


def well_report(demux: DataFrame, downsampled: DataFrame, unmapped: DataFrame, dedup: DataFrame) -> DataFrame:
    """One row a well. ``demux``: bc_idx, well, TOTAL_IN, PASS and other counts; ``downsampled``: bc_idx, out;
    ``unmapped``: bc_idx, count; ``dedup``: bc_idx and the nine counters. Missing wells count 0; a loss from 0 is null.

    Unmapped discards are taken from ``unmapped`` if deduplication saw none at all.
    """
    counters = [c for c in dedup.columns if c != "bc_idx"]
    met = demux.join(downsampled.select("bc_idx", "out"), "bc_idx", "left").join(unmapped.select("bc_idx", F.col("count").alias("UNMAPPED")), "bc_idx", "left").join(dedup, "bc_idx", "left")
    met = met.fillna(0, subset=["out", "UNMAPPED", *counters])
    seen = dedup.agg(F.coalesce(F.sum("DISCARD_UNMAPPED"), F.lit(0)).alias("seen"))  # one row
    met = met.crossJoin(F.broadcast(seen)).withColumn("DISCARD_UNMAPPED", F.when(F.col("seen") == 0, F.col("UNMAPPED")).otherwise(F.col("DISCARD_UNMAPPED"))).drop("seen")
    mapped = F.col("out") - F.col("UNMAPPED")
    losses = {
        "PCT_LOSS_QC": _loss(F.col("TOTAL_IN"), F.col("PASS")), "PCT_LOSS_DOWNSAMPLING": _loss(F.col("PASS"), F.col("out")), "PCT_LOSS_UNMAPPED": _loss(F.col("out"), mapped),
        "PCT_LOSS_UNASSIGNED": _loss(mapped, F.col("PASSED_QC")), "PCT_LOSS_UMI": _loss(F.col("PASSED_QC"), F.col("UMI_COUNTS")),
    }
    others = [c for c in demux.columns if c not in ("bc_idx", "well", "TOTAL_IN")]
    qc = [F.col(c).alias(f"MATCH_{c.upper()}" if c.startswith("mm_") else f"QC_{c}") for c in others]
    return met.select(
        "bc_idx", "well", "TOTAL_IN", *(v.alias(k) for k, v in losses.items()), F.col("UMI_COUNTS").alias("FINAL_UMI"), *qc,
        F.col("out").alias("DOWNSAMPLE_OUT"), F.col("UNMAPPED").alias("UNMAP_COUNT"), *(F.col(c).alias(f"DEDUP_{c}") for c in counters),
    )


def solo_report(demux: DataFrame, downsampled: DataFrame, unmapped: DataFrame, totals: DataFrame) -> DataFrame:
    """The report of the pipeline whose aligner counts: the last step is ``totals`` (bc_idx, total)."""
    met = demux.join(downsampled.select("bc_idx", "out"), "bc_idx", "left").join(unmapped.select("bc_idx", F.col("count").alias("UNMAPPED")), "bc_idx", "left").join(totals, "bc_idx", "left")
    met = met.fillna(0, subset=["out", "UNMAPPED", "total"])
    mapped = F.col("out") - F.col("UNMAPPED")
    return met.select(
        "bc_idx", "well", "TOTAL_IN", _loss(F.col("TOTAL_IN"), F.col("PASS")).alias("PCT_LOSS_QC"), _loss(F.col("PASS"), F.col("out")).alias("PCT_LOSS_DOWNSAMPLING"),
        _loss(F.col("out"), mapped).alias("PCT_LOSS_UNMAPPED"), _loss(mapped, F.col("total")).alias("PCT_LOSS_UMI"), F.col("total").alias("FINAL_UMI"),
    )


def solo_totals(counts: DataFrame) -> DataFrame:
    """bc_idx, total: sums over genes, rounded half to even."""
    return counts.groupBy("bc_idx").agg(F.bround(F.sum("count")).cast("long").alias("total"))


def merge_matrices(rows: DataFrame) -> DataFrame:
    """Shards of a count matrix (gene, bc_idx, count) summed."""
    return rows.groupBy("gene", "bc_idx").agg(F.sum("count").alias("count"))


def merge_counters(rows: DataFrame) -> DataFrame:
    """Shards of deduplication counters summed by well."""
    return rows.groupBy("bc_idx").agg(*(F.sum(c).alias(c) for c in rows.columns if c != "bc_idx"))


def merge_summaries(rows: DataFrame) -> DataFrame:
    """Aligner summaries (sample, name, value text) of several runs: numbers of reads summed, other values weighted by them.

    "NoMulti" counts as 0.
    """
    value = F.when(F.col("value") == "NoMulti", F.lit(0.0)).otherwise(F.col("value").cast("double"))
    v = rows.select("sample", "name", value.alias("v"))
    reads = v.where("name = 'Number of Reads'").select("sample", F.col("v").alias("w"))
    return v.join(reads, "sample").groupBy("name").agg(F.when(F.col("name") == "Number of Reads", F.sum("v")).otherwise(F.try_divide(F.sum(F.col("v") * F.col("w")), F.sum("w"))).alias("value"))


def merge_statuses(rows: DataFrame) -> DataFrame:
    """Gene-assignment summaries (status, count) summed."""
    return rows.groupBy("status").agg(F.sum("count").alias("count"))


def dense(counts: DataFrame, wells: list[int], value: str = "count") -> DataFrame:
    """gene and a column for each well; ``wells`` are those of one plate."""
    wide = counts.groupBy("gene").pivot("bc_idx", wells).agg(F.sum(value))
    return wide.select("gene", *(F.coalesce(F.col(f"`{w}`"), F.lit(0)).alias(f"{w:04d}") for w in wells))


def per_position_quality(reads: DataFrame, phred: int = 33) -> DataFrame:
    """position, reads, mean_quality over all reads."""
    at = reads.select(F.posexplode(F.filter(F.split("cdna_qual", ""), lambda c: c != "")).alias("p", "c"))
    return at.groupBy((F.col("p") + 1).alias("position")).agg(F.count("*").alias("reads"), F.avg(F.ascii("c") - phred).alias("mean_quality"))
