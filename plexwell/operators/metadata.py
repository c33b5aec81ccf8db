"""Rules for experiment metadata: what is wrong with a table, as rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed names of the metadata format.
REQUIRED = ("Plate", "PoolName", "Pool_Index_i7", "Well_Index", "WellBarcode", "SampleName", "Genome", "SampleID")
UNIQUE = ("Well_Index", "WellBarcode", "SampleID")
SINGLE = ("Pool_Index_i7", "Genome")
#: Genomes of older species names.
GENOMES = {"Human": "GRCh38", "Mouse": "mm10", "Human + mouse": "GRCh38_mm10", "Macaque": "Mmul10", "Rat": "rat6"}

#: Spellings of MaskWells.
MASKED, UNMASKED = ("1", "1.0", "true"), ("0", "0.0", "false")


def with_genome(metadata: DataFrame, genomes: dict[str, str] | None = None) -> DataFrame:
    """Genome from the older Species column where there is no Genome; unknown ones become Unknown__name."""
    if "Genome" in metadata.columns or "Species" not in metadata.columns:
        return metadata
    table = F.create_map(*(F.lit(x) for pair in (genomes or GENOMES).items() for x in pair))
    return metadata.withColumn("Genome", F.coalesce(F.try_element_at(table, F.col("Species")), F.concat(F.lit("Unknown__"), "Species")))


def complete_rows(metadata: DataFrame) -> DataFrame:
    return metadata.dropna(subset=list(REQUIRED))


def violations(metadata: DataFrame) -> DataFrame:
    """rule, column, value, rows of everything that breaks a rule; empty for sound metadata.

    missing: a required column is absent or only null; format: other characters than letters, digits, ``_ . % -``; unique: a
    value stands in several rows; single: a column has several values; mask: MaskWells is neither 0, 1 nor null.
    """
    spark = metadata.sparkSession
    absent = [c for c in REQUIRED if c not in metadata.columns]
    schema = "rule string, column string, value string, rows long"
    if absent:
        return spark.createDataFrame([("missing", c, None, 0) for c in absent], schema)
    nulls = metadata.agg(*(F.count(c).alias(c) for c in REQUIRED)).unpivot([], list(REQUIRED), "column", "n")
    found = [nulls.where("n = 0").select(F.lit("missing").alias("rule"), "column", F.lit(None).cast("string").alias("value"), F.lit(0).cast("long").alias("rows"))]
    rows = complete_rows(metadata)
    values = rows.select(*(F.col(c).cast("string").alias(c) for c in REQUIRED)).unpivot([], list(REQUIRED), "column", "value").groupBy("column", "value").agg(F.count("*").alias("rows"))
    found.append(values.where(~F.col("value").rlike(r"^[\w.%-]+$") & (F.col("column") != "Pool_Index_i7")).select(F.lit("format").alias("rule"), "column", "value", "rows"))
    found.append(values.where(F.col("column").isin(*UNIQUE) & (F.col("rows") > 1)).select(F.lit("unique").alias("rule"), "column", "value", "rows"))
    many = values.where(F.col("column").isin(*SINGLE)).groupBy("column").agg(F.count("*").alias("n"), F.sum("rows").alias("rows")).where("n > 1")
    found.append(many.select(F.lit("single").alias("rule"), "column", F.col("n").cast("string").alias("value"), "rows"))
    if "MaskWells" in metadata.columns:
        text = F.col("MaskWells").cast("string")
        bad = rows.where(text.isNotNull() & ~F.lower(text).isin(*MASKED, *UNMASKED))
        found.append(bad.groupBy(text.alias("value")).agg(F.count("*").alias("rows")).select(F.lit("mask").alias("rule"), F.lit("MaskWells").alias("column"), "value", "rows"))
    return reduce(DataFrame.unionByName, found)


def masked(metadata: DataFrame) -> DataFrame:
    """MaskWells as a boolean, by the spellings that ``violations`` accepts; null and others are false."""
    return metadata.withColumn("MaskWells", F.coalesce(F.lower(F.col("MaskWells").cast("string")).isin(*MASKED), F.lit(False)))


def missing_indices(metadata: DataFrame, sample_sheet: DataFrame) -> DataFrame:
    """Pool indices that the sample sheet lacks (``sample_sheet``: Index)."""
    return metadata.select("Pool_Index_i7").distinct().join(sample_sheet, F.col("Pool_Index_i7") == F.col("Index"), "left_anti")


def coordinates(metadata: DataFrame) -> DataFrame:
    """x and y (from 1) of well names like B7: the number is x, the letter y."""
    cell = F.regexp_extract("Well_Index", r"^([A-Z])([0-9]+)$", 1)
    return metadata.withColumns({"x": F.regexp_extract("Well_Index", r"^([A-Z])([0-9]+)$", 2).try_cast("int"), "y": F.when(cell != "", F.ascii(cell) - 64)})


def duplicate_barcodes(whitelist: DataFrame) -> DataFrame:
    """column, value, rows of sequences and names that several wells share."""
    out = [whitelist.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("rows")).where("rows > 1").select(F.lit(c).alias("column"), "value", "rows") for c in ("seq", "well")]
    return out[0].unionByName(out[1])


def layout_lengths(layout: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Lengths of barcodes on either side; sound inputs have one row in all."""
    own = layout.where("seq <> ''").select(F.length("seq").alias("length")).unionByName(whitelist.select(F.length("seq").alias("length")))
    return own.distinct()


@dataclass(frozen=True)
class Parameters:
    """Settings of a run, checked when made."""

    barcode_length: int = 16
    umi_length: int = 10
    mismatch: int = 1
    umi_mismatch: int = 2
    umi_lookback: int = 10
    strandness: int = 1
    phred: int = 33
    strategies: tuple[str, ...] = ("Unique",)
    em_iterations: int = 100
    em_max_diff: float = 0.01
    em_small: float = 0.01

    def __post_init__(self) -> None:
        if self.umi_length < 1 or self.barcode_length < 1:
            raise ValueError("barcodes and UMIs have at least one base")
        if self.umi_mismatch * 3 >= self.umi_length:
            raise ValueError("three times the UMI mismatches must be less than the UMI's length")
        if self.mismatch < 0 or self.umi_mismatch < 0 or self.umi_lookback < 0 or self.em_iterations < 1:
            raise ValueError("limits can't be negative")
        if self.strandness not in (0, 1, 2):
            raise ValueError("strandness is 0, 1 or 2")
        unknown = set(self.strategies) - {"Unique", "Uniform", "PropUnique", "Rescue", "EM"}
        if unknown:
            raise ValueError(f"unknown strategies: {sorted(unknown)}")
