"""Gene counts of deduplicated reads, and shares of reads that several genes have."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def count_unique(reads: DataFrame) -> DataFrame:
    """bc_idx, gene, count of kept reads with one gene. ``reads``: bc_idx, genes, duplicate."""
    own = reads.where(~F.coalesce("duplicate", F.lit(False)) & (F.size("genes") == 1) & (F.col("bc_idx") >= 0))
    return own.groupBy("bc_idx", F.get("genes", 0).alias("gene")).agg(F.count("*").alias("count"))


def count_sets(reads: DataFrame) -> DataFrame:
    """bc_idx, genes, count of kept reads by their set of two or more genes."""
    own = reads.where(~F.coalesce("duplicate", F.lit(False)) & (F.size("genes") > 1) & (F.col("bc_idx") >= 0))
    return own.groupBy("bc_idx", F.array_sort("genes").alias("genes")).agg(F.count("*").alias("count"))


def _members(sets: DataFrame, unique: DataFrame) -> DataFrame:
    """A row for each gene of each set: bc_idx, set, gene, r (reads), k (genes), u (unique reads of the gene), total (of the set).

    A set is known by its hash; only it and numbers are moved, and the sum over a set is a window over its own rows.
    """
    rows = sets.select("bc_idx", F.xxhash64("genes").alias("set"), F.explode("genes").alias("gene"), F.col("count").cast("double").alias("r"), F.size("genes").alias("k"))
    met = rows.join(unique.withColumnRenamed("count", "u"), ["bc_idx", "gene"], "left").withColumn("u", F.coalesce("u", F.lit(0)).cast("double"))
    return met.withColumn("total", F.sum("u").over(Window.partitionBy("bc_idx", "set")))


def _added(unique: DataFrame, shares: DataFrame) -> DataFrame:
    """Unique counts and shares in one table: bc_idx, gene, count."""
    rows = unique.select("bc_idx", "gene", F.col("count").cast("double").alias("count")).unionByName(shares.select("bc_idx", "gene", F.col("share").alias("count")))
    return rows.groupBy("bc_idx", "gene").agg(F.sum("count").alias("count"))


def uniform(unique: DataFrame, sets: DataFrame) -> DataFrame:
    """Each gene of a set gets an equal share of its reads."""
    rows = sets.select("bc_idx", F.explode("genes").alias("gene"), (F.col("count") / F.size("genes")).alias("share"))
    return _added(unique, rows)


def prop_unique(unique: DataFrame, sets: DataFrame) -> DataFrame:
    """Shares in proportion to unique reads; equal ones where no gene of the set has any."""
    m = _members(sets, unique)
    return _added(unique, m.select("bc_idx", "gene", F.when(F.col("total") > 0, F.col("r") * F.col("u") / F.col("total")).otherwise(F.col("r") / F.col("k")).alias("share")))


def rescue(unique: DataFrame, sets: DataFrame) -> DataFrame:
    """Shares in proportion to unique reads and an equal part of the set's own."""
    m = _members(sets, unique)
    return _added(unique, m.select("bc_idx", "gene", (F.col("r") * (F.col("u") + F.col("r") / F.col("k")) / (F.col("total") + F.col("r"))).alias("share")))


def _em(iterations: int, max_diff: float, small: float):
    def run(key, unique: pa.Table, sets: pa.Table) -> pa.Table:
        own = dict(zip(unique["gene"].to_pylist(), unique["count"].to_pylist(), strict=True))
        listed = sets["genes"].to_pylist()
        genes = sorted(own.keys() | {g for s in listed for g in s})
        place = {g: i for i, g in enumerate(genes)}
        u = np.array([own.get(g, 0) for g in genes], np.float64)
        value = u
        if listed:
            r = np.array(sets["count"].to_pylist(), np.float64)
            sizes = np.array([len(s) for s in listed])
            at, of = np.array([place[g] for s in listed for g in s]), np.repeat(np.arange(len(listed)), sizes)
            value = u + np.bincount(at, (r / sizes)[of], len(genes))
            for _ in range(iterations):
                old = np.where(value < small, 0.0, value)
                total = np.bincount(of, old[at], len(listed))
                with np.errstate(invalid="ignore", divide="ignore"):
                    share = np.where(total[of] > 0, old[at] / total[of], 1.0 / sizes[of])  # a set whose genes all vanished shares equally
                new = u + np.bincount(at, r[of] * share, len(genes))
                done = np.abs(new - old).max() < max_diff
                value = new
                if done:
                    break
        return pa.table({"bc_idx": pa.array([key[0].as_py()] * len(genes), pa.int32()), "gene": pa.array(genes, sets.schema.field("genes").type.value_type), "count": pa.array(value)})

    return run


def expectation_maximisation(unique: DataFrame, sets: DataFrame, iterations: int = 100, max_diff: float = 0.01, small: float = 0.01) -> DataFrame:
    """Shares in proportion to the estimate before, from the uniform one on, until no gene of a well moves by ``max_diff``.

    Wells are scanned each for itself: what one task holds are a well's distinct genes and gene sets, bounded by the
    annotation, not by its reads.
    """
    kind = dict(unique.dtypes)["gene"]
    left = unique.select(F.col("bc_idx").cast("int").alias("bc_idx"), "gene", "count").groupBy("bc_idx")
    right = sets.select(F.col("bc_idx").cast("int").alias("bc_idx"), "genes", "count").groupBy("bc_idx")
    return left.cogroup(right).applyInArrow(_em(iterations, max_diff, small), f"bc_idx int, gene {kind}, count double")


STRATEGIES = {"Uniform": uniform, "PropUnique": prop_unique, "Rescue": rescue, "EM": expectation_maximisation}


def count_matrices(reads: DataFrame, strategies: list[str]) -> dict[str, DataFrame]:
    """Unique and the named strategies' counts, each as bc_idx, gene, count."""
    unique, sets = count_unique(reads), count_sets(reads)
    return {"Unique": unique} | {s: STRATEGIES[s](unique, sets) for s in strategies}
