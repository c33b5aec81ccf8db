"""Counts by gene length and depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _with_lengths(counts: DataFrame, lengths: DataFrame, wells: DataFrame, fragment_lengths: DataFrame | None, excluded: DataFrame | None) -> DataFrame:
    """Every annotated gene of every well: bc_idx, gene, count, length (adjusted), counted (in the denominator)."""
    # wells and genes are dimensions of fixed size (a plate, an annotation), and every pair is in the result
    grid = wells.select("bc_idx").crossJoin(lengths.select("gene", F.col("length").cast("double").alias("length")))
    met = grid.join(counts, ["bc_idx", "gene"], "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("double"))
    if fragment_lengths is not None:
        met = met.join(fragment_lengths, "bc_idx", "left").withColumn("length", F.greatest(F.col("length") - F.coalesce("fragment_length", F.lit(0)), F.lit(0.0)))
    if excluded is not None:
        met = met.join(excluded.select("gene", F.lit(True).alias("out")), "gene", "left").withColumn("counted", F.col("out").isNull()).drop("out")
    else:
        met = met.withColumn("counted", F.lit(True))
    return met


def tpm(counts: DataFrame, lengths: DataFrame, wells: DataFrame, fragment_lengths: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """bc_idx, gene, tpm: reads by length, as millionths of their sum over a well.

    ``fragment_lengths`` (bc_idx, fragment_length) shortens genes; ``excluded`` genes don't count in the sum. Genes
    without length have 0, and so has everything where the sum is 0.
    """
    m = _with_lengths(counts, lengths, wells, fragment_lengths, excluded)
    rate = F.when(F.col("length") > 0, F.col("count") / F.col("length"))
    m = m.withColumn("rate", rate)
    total = F.sum(F.when(F.col("counted"), F.col("rate"))).over(Window.partitionBy("bc_idx"))
    return m.select("bc_idx", "gene", F.coalesce(F.try_divide(F.col("rate") * 1e6, total), F.lit(0.0)).alias("tpm"))


def fpkm(counts: DataFrame, lengths: DataFrame, wells: DataFrame, fragment_lengths: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """bc_idx, gene, fpkm: reads by length and by the well's reads, times 10^9."""
    m = _with_lengths(counts, lengths, wells, fragment_lengths, excluded)
    total = F.sum(F.when(F.col("counted"), F.col("count"))).over(Window.partitionBy("bc_idx"))
    value = F.when(F.col("length") > 0, F.try_divide(F.col("count") * 1e9, total) / F.col("length"))
    return m.select("bc_idx", "gene", F.coalesce(value, F.lit(0.0)).alias("fpkm"))


def ribosomal(genes: DataFrame) -> DataFrame:
    """Genes whose biotype says rRNA."""
    return genes.where(F.contains("biotype", F.lit("rRNA"))).select("gene")
