"""Filters and trims of reads; the first rule a read fails is its outcome."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexwell.functions.sequences import adapter_at, count_of, fuzzy_homopolymer_at, homopolymer_at, low_qualities, quality_cut

#: Outcomes in their order (fixed names of the result format).
REASONS = (
    "PASS", "FAIL_UMI_QUALITY", "FAIL_AT_CONTENT", "FAIL_GC_CONTENT", "FAIL_LENGTH", "FAIL_HOMOPOLYMER", "FAIL_ADAPTER_TRIMMING", "FAIL_QUALITY_TRIMMING", "FAIL_DUPLICATE",
)


@dataclass(frozen=True)
class QcRules:
    """Limits; a rule is off where its limit says so in the comment."""

    min_length: int = 20  # 0: off
    min_quality: int = 20  # 0: no trimming, no UMI filter
    min_umi_bases: int = 6  # at most so many UMI bases may lie below min_quality
    homopolymer: int = 10  # 5 or less: off
    homopolymer_mismatch: int = 0
    max_at: float = 0.9  # both of these at 1: off
    max_gc: float = 0.9
    adapter: str = ""  # shorter than 5: off
    phred: int = 33
    duplicates: bool = False

    def __post_init__(self) -> None:
        if not 0 <= self.max_at <= 1 or not 0 <= self.max_gc <= 1:
            raise ValueError("contents are fractions")
        if min(self.min_length, self.min_quality, self.min_umi_bases, self.homopolymer, self.homopolymer_mismatch) < 0:
            raise ValueError("limits can't be negative")


def quality_control(reads: DataFrame, rules: QcRules) -> DataFrame:
    """``reads`` with qc, and cdna_seq and cdna_qual as far as they were trimmed before the rule that failed, if any did.

    The state of a read goes from rule to rule as a bound value and comes out of a generator, so that no later filter or
    projection takes a copy of the rules apart: each is evaluated once.
    """
    fail = F.lit(None).cast("string")
    seq = F.col("cdna_seq")
    length = F.length(seq)
    if rules.min_quality > 0:
        fail = F.when(low_qualities(F.col("umiqual"), rules.min_quality, rules.phred) > rules.min_umi_bases, "FAIL_UMI_QUALITY")
    if rules.max_at < 1 and rules.max_gc < 1:
        fail = F.coalesce(fail, F.when(count_of(seq, "AT") >= rules.max_at * length, "FAIL_AT_CONTENT"), F.when(count_of(seq, "CG") >= rules.max_gc * length, "FAIL_GC_CONTENT"))
    if rules.min_length > 0:
        fail = F.coalesce(fail, F.when(length < rules.min_length, "FAIL_LENGTH"))
    state = F.struct(fail.alias("qc"), seq.alias("cdna_seq"), F.col("cdna_qual").alias("cdna_qual"))

    def bound(value: Column, f: Callable[[Column], Column]) -> Column:
        return F.transform(F.array(value), f)[0]

    def trim(state: Column, at: Callable[[Column, Column], Column], reason: str) -> Column:
        def cut(x: Column) -> Column:
            keep = F.when(x["at"] >= rules.min_length, x["at"]).otherwise(F.length(x["s"]["cdna_seq"]))
            keep = F.coalesce(keep, F.length(x["s"]["cdna_seq"]))
            return F.struct(
                F.coalesce(x["s"]["qc"], F.when(x["at"] < rules.min_length, reason)).alias("qc"),
                F.substr(x["s"]["cdna_seq"], F.lit(1), keep).alias("cdna_seq"), F.substr(x["s"]["cdna_qual"], F.lit(1), keep).alias("cdna_qual"),
            )

        return bound(state, lambda s: bound(F.struct(s.alias("s"), F.when(s["qc"].isNull(), at(s["cdna_seq"], s["cdna_qual"])).alias("at")), cut))

    if rules.homopolymer > 5:
        fuzzy = rules.homopolymer_mismatch
        state = trim(state, lambda s, _: fuzzy_homopolymer_at(s, rules.homopolymer, fuzzy) if fuzzy else homopolymer_at(s, rules.homopolymer), "FAIL_HOMOPOLYMER")
    if len(rules.adapter) >= 5:
        state = trim(state, lambda s, _: adapter_at(s, rules.adapter), "FAIL_ADAPTER_TRIMMING")
    if rules.min_quality > 0:
        state = trim(state, lambda s, q: quality_cut(s, q, rules.min_quality, rules.phred), "FAIL_QUALITY_TRIMMING")
    others = [c for c in reads.columns if c not in ("qc", "cdna_seq", "cdna_qual")]
    out = reads.select(*others, F.inline(F.array(state)))
    if rules.duplicates:
        first = F.row_number().over(Window.partitionBy("cdna_seq", "bcseq", "umiseq", F.col("qc").isNull()).orderBy("name"))
        out = out.withColumn("qc", F.coalesce("qc", F.when(first > 1, "FAIL_DUPLICATE")))
    return out.withColumn("qc", F.coalesce("qc", F.lit("PASS")))


def slice_read1(pairs: DataFrame, barcode_length: int, umi_length: int) -> DataFrame:
    """Barcode and UMI cut from the first read (r1_seq, r1_qual); a read shorter than both is an error."""
    short = F.length("r1_seq") < barcode_length + umi_length
    checked = F.when(short, F.raise_error(F.concat(F.lit("read 1 is too short: "), F.col("name")))).otherwise(F.col("r1_seq"))
    cut = pairs.withColumn("r1_seq", checked)
    return cut.withColumns(
        {
            "bcseq": F.substring("r1_seq", 1, barcode_length), "umiseq": F.substring("r1_seq", barcode_length + 1, umi_length),
            "bcqual": F.substring("r1_qual", 1, barcode_length), "umiqual": F.substring("r1_qual", barcode_length + 1, umi_length),
        }
    ).drop("r1_seq", "r1_qual")


def passed(reads: DataFrame) -> DataFrame:
    return reads.where("qc = 'PASS'")
