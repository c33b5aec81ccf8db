"""Sinks whose formats ask for certain file names: the matrix folder of single-cell tools, and text tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexwell.operators.reports import dense


def write_matrix(counts: DataFrame, features: list[tuple[str, str]], barcodes: list[str], folder: str, name: str = "matrix.mtx", integer: bool = True) -> None:
    """barcodes.tsv, features.tsv and a MatrixMarket file (from 1, by well, then gene) of ``counts`` (bc_idx, gene, count).

    Rows are streamed through the driver in order; a matrix has at most genes times wells of one plate.
    """
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/barcodes.tsv", "w") as f:
        f.writelines(f"{b}\n" for b in barcodes)
    with open(f"{folder}/features.tsv", "w") as f:
        f.writelines(f"{i}\t{n}\tGene Expression\n" for i, n in features)
    spark = counts.sparkSession
    places = spark.createDataFrame([(i, k + 1) for k, (i, _) in enumerate(features)], f"gene {dict(counts.dtypes)['gene']}, row long")
    rows = counts.where("count <> 0").join(F.broadcast(places), "gene").select("row", (F.col("bc_idx") + 1).alias("col"), "count").orderBy("col", "row")
    with open(f"{folder}/{name}", "w") as f:
        f.write(f"%%MatrixMarket matrix coordinate {'integer' if integer else 'real'} general\n")
        f.write(f"{len(features)} {len(barcodes)} {rows.count()}\n")
        f.writelines(f"{r['row']} {r['col']} {int(r['count']) if integer else repr(float(r['count']))}\n" for r in rows.toLocalIterator())


def write_dense(counts: DataFrame, wells: list[int], path: str) -> None:
    """A tab-separated table of genes by wells, as Spark part files."""
    dense(counts, wells).orderBy("gene").write.option("sep", "\t").option("header", True).csv(path)


def write_counters(counters: DataFrame, path: str) -> None:
    """Deduplication counters as tab-separated part files."""
    counters.orderBy("bc_idx").write.option("sep", "\t").option("header", True).csv(path)


def write_values(values: DataFrame, wells: list[int], value: str, path: str) -> None:
    """TPM or FPKM as a tab-separated table with eight significant digits."""
    wide = dense(values, wells, value)
    wide.select("gene", *(F.format_string("%.8g", F.col(c).cast("double")).alias(c) for c in wide.columns[1:])).orderBy("gene").write.option("sep", "\t").option("header", True).csv(path)


def write_by_well(reads: DataFrame, path: str) -> None:
    """Parquet, a folder for each well."""
    reads.write.partitionBy("bc_idx").parquet(path)
