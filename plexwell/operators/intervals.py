"""Genomic ranges: assignment of alignments to genes, and exon unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(end / width)))


def overlap_join(left: DataFrame, right: DataFrame, width: int = 4096) -> DataFrame:
    """Rows of both sides whose ranges (chrom, start to end, both ends inside) overlap; ``right`` has start_r, end_r.

    Ranges are cut into bins and joined on them, so no range predicate is planned as nested loops. A pair that shares several
    bins is kept in the first one only: no distinct is needed.
    """
    a = left.withColumn("bin", _bins(F.col("start"), F.col("end"), width))
    b = right.withColumn("bin", _bins(F.col("start_r"), F.col("end_r"), width))
    met = a.join(b, ["chrom", "bin"]).where((F.col("start") <= F.col("end_r")) & (F.col("start_r") <= F.col("end")))
    return met.where(F.col("bin") == F.floor(F.greatest("start", "start_r") / width)).drop("bin")


def assign_genes(alignments: DataFrame, exons: DataFrame, strandness: int = 1, min_fraction: float = 0.0, width: int = 4096) -> DataFrame:
    """``alignments`` (aln_id, chrom, strand, start, end ...) with xs and xt (sorted genes).

    ``strandness`` 0: any strand, 1: the exon's, 2: the other. All genes count that an alignment overlaps by at least
    ``min_fraction`` of its bases (joined over the gene's exons, whose overlaps are merged) and one base.
    """
    e = exons.select("chrom", F.col("strand").alias("strand_r"), F.col("start").alias("start_r"), F.col("end").alias("end_r"), "gene")
    met = overlap_join(alignments.select("aln_id", "chrom", "strand", "start", "end"), e, width)
    if strandness == 1:
        met = met.where("strand = strand_r")
    elif strandness == 2:
        met = met.where("strand <> strand_r")
    if min_fraction > 0:
        met = met.select("aln_id", "gene", F.greatest("start", "start_r").alias("a"), F.least("end", "end_r").alias("b"), (F.col("end") - F.col("start") + 1).alias("n"))
        w = Window.partitionBy("aln_id", "gene").orderBy("a", "b")
        seen = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
        met = met.withColumn("fresh", F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(seen + 1, "a")) + 1))
        met = met.groupBy("aln_id", "gene").agg(F.sum("fresh").alias("bases"), F.first("n").alias("n")).where(F.col("bases") >= F.col("n") * min_fraction)
    genes = met.groupBy("aln_id").agg(F.array_sort(F.collect_set("gene")).alias("xt"))
    out = alignments.join(genes, "aln_id", "left")
    return out.withColumns({"xs": F.when(F.col("xt").isNull(), "Unassigned_NoFeatures").otherwise("Assigned"), "xt": F.coalesce("xt", F.array().cast(dict(genes.dtypes)["xt"]))})


def effective_lengths(exons: DataFrame) -> DataFrame:
    """gene, length: the union of a gene's exons (start, end), touching ones merged, each block counted as end - start."""
    distinct = exons.select("gene", "start", "end").distinct()
    w = Window.partitionBy("gene").orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = distinct.withColumn("fresh", (reach.isNull() | (reach < F.col("start") - 1)).cast("int"))
    blocks = opened.withColumn("block", F.sum("fresh").over(w)).groupBy("gene", "block").agg((F.max("end") - F.min("start")).alias("n"))
    return blocks.groupBy("gene").agg(F.sum("n").alias("length"))


def mean_fragment_length(alignments: DataFrame, min_mapq: int = 0) -> DataFrame:
    """One row: the whole part of the mean length of primary, mapped, passing alignments (seq_length)."""
    own = alignments.where("is_mapped and is_primary and not qcfail").where(F.col("mapq") >= min_mapq)
    return own.agg(F.floor(F.avg("seq_length")).alias("fragment_length"))
