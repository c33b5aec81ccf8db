"""Text tables of the domain: annotation, whitelists, layouts, sample sheets, reports and matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_gtf(spark: SparkSession, path: str, *features: str) -> DataFrame:
    """seqname, source, feature, start, end (from 0, both inside), score, strand, frame, attr (map of texts).

    Only the named features, if any are.
    """
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != ""))
    f = F.split("value", "\t")
    pair = r'([A-Za-z_][\w.]*) +(?:"([^"]*)"|([^";\s]+))'
    attributes = F.map_from_entries(
        F.transform(
            F.array_distinct(F.regexp_extract_all(f[8], F.lit(r'([A-Za-z_][\w.]* +(?:"[^"]*"|[^";\s]+))'), F.lit(1))),
            lambda x: F.struct(F.regexp_extract(x, pair, 1), F.concat(F.regexp_extract(x, pair, 2), F.regexp_extract(x, pair, 3))),
        )
    )
    rows = lines.select(
        f[0].alias("seqname"), f[1].alias("source"), f[2].alias("feature"), (f[3].cast("long") - 1).alias("start"), (f[4].cast("long") - 1).alias("end"),
        f[5].try_cast("double").alias("score"), f[6].alias("strand"), f[7].alias("frame"), f[8].alias("told"), attributes.alias("attr"),
    ).drop("told")
    return rows.where(F.col("feature").isin(*features)) if features else rows


def exons_of(gtf: DataFrame, key: str = "gene_id") -> DataFrame:
    e = gtf.where("feature = 'exon'").where(F.map_contains_key("attr", key))
    return e.select(F.col("seqname").alias("chrom"), "strand", "start", "end", F.element_at("attr", key).alias("gene"), F.try_element_at("attr", F.lit("gene_biotype")).alias("biotype"))


def read_whitelist(spark: SparkSession, path: str) -> DataFrame:
    """bc_idx (file order), seq, well, x, y, mask; the last three may be absent."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.split("value", "\r?\n"), lambda x: x != "")).alias("bc_idx", "value"))
    f = F.split("value", "\t")
    if lines.where(F.size(f) < 2).count():
        raise ValueError("a well has no name")
    out = lines.select("bc_idx", f[0].alias("seq"), f[1].alias("well"), F.get(f, 2).cast("int").alias("x"), F.get(f, 3).cast("int").alias("y"), F.coalesce(F.lower(F.get(f, 4)) == "true", F.lit(False)).alias("mask"))
    if out.select(F.length("seq")).distinct().count() > 1:
        raise ValueError("barcodes differ in length")
    return out


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """y, x (from 1) and seq of each cell; empty cells stay."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.rtrim(F.regexp_replace("value", r"\n+\z", "")), "\r?\n")).alias("p", "value"))
    return rows.select((F.col("p") + 1).alias("y"), F.posexplode(F.split("value", ",", -1)).alias("q", "seq")).select("y", (F.col("q") + 1).alias("x"), "seq")


def read_sample_sheet(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """The [Data] section of a sample sheet, with its header's columns."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "value"))
    section = F.when(F.col("value").startswith("["), F.regexp_extract("value", r"^\[([^\]]*)\]", 1))
    w = Window.orderBy("n")  # one small file
    data = lines.withColumn("section", F.last(section, ignorenulls=True).over(w)).where("section = 'Data'").where(~F.col("value").startswith("[") & (F.trim(F.replace("value", F.lit(","), F.lit(""))) != ""))
    head = data.orderBy("n").first()
    if head is None:
        raise ValueError("the sheet has no data")
    names = head["value"].split(",")
    missing = [c for c in required if c not in names]
    if missing:
        raise ValueError(f"the sheet lacks {missing}")
    f = F.split("value", ",", -1)
    return data.where(F.col("n") > head["n"]).select(*(F.get(f, k).alias(c) for k, c in enumerate(names)))


def read_demux_json(spark: SparkSession, *paths: str) -> DataFrame:
    """One row a file: read_count, well_counts, mismatch_counts, fail_counts (maps) and unmatched_counts if they have it."""
    counts = "map<string,long>"
    return spark.read.schema(f"read_count long, well_counts {counts}, written_counts array<long>, mismatch_counts array<{counts}>, fail_counts map<string,{counts}>, unmatched_counts {counts}").json(list(paths), multiLine=True)


def merge_demux_json(reports: DataFrame) -> DataFrame:
    """facet, key, well, count summed over files."""
    wells = reports.select(F.lit("well").alias("facet"), F.lit("").alias("key"), F.explode("well_counts").alias("well", "count"))
    fails = reports.select(F.explode("fail_counts").alias("key", "m")).select(F.lit("fail").alias("facet"), "key", F.explode("m").alias("well", "count"))
    hist = reports.select(F.posexplode("mismatch_counts").alias("key", "m")).select(F.lit("mismatch").alias("facet"), F.col("key").cast("string").alias("key"), F.explode("m").alias("well", "count"))
    odd = reports.select(F.lit("unmatched").alias("facet"), F.lit("").alias("key"), F.explode("unmatched_counts").alias("well", "count"))
    return wells.unionByName(fails).unionByName(hist).unionByName(odd).groupBy("facet", "key", "well").agg(F.sum("count").alias("count"))


def read_matrix_market(spark: SparkSession, *paths: str) -> DataFrame:
    """gene_idx, bc_idx (from 0) and count, summed over files in coordinate format."""
    lines = spark.read.text(list(paths)).where(~F.col("value").startswith("%") & (F.trim("value") != ""))
    f = F.split(F.trim("value"), r"\s+")
    rows = lines.select("*", F.input_file_name().alias("file")).select("file", f[0].cast("long").alias("i"), f[1].cast("long").alias("j"), f[2].cast("double").alias("v"), F.monotonically_increasing_id().alias("at"))
    # the first line of a file is its size
    sizes = rows.groupBy("file").agg(F.min("at").alias("at"))
    return rows.join(F.broadcast(sizes), ["file", "at"], "left_anti").groupBy((F.col("i") - 1).alias("gene_idx"), (F.col("j") - 1).alias("bc_idx")).agg(F.sum("v").alias("count"))


def read_assignment_summary(spark: SparkSession, *paths: str) -> DataFrame:
    """status, count of gene-assignment summaries (a header line each)."""
    f = F.split("value", "\t")
    return spark.read.text(list(paths)).where(~F.col("value").startswith("Status")).select(f[0].alias("status"), f[1].cast("long").alias("count"))


def read_solo_features(spark: SparkSession, *paths: str) -> DataFrame:
    """name, count of fixed-width aligner statistics (50 characters, then a number), summed over files."""
    rows = spark.read.text(list(paths)).where(F.trim("value") != "")
    return rows.select(F.trim(F.substring("value", 1, 50)).alias("name"), F.trim(F.substring("value", 51, 15)).cast("long").alias("count")).groupBy("name").agg(F.sum("count").alias("count"))


def read_solo_summary(spark: SparkSession, *paths: str) -> DataFrame:
    """sample (the file), name, value of comma-separated summaries."""
    return spark.read.text(list(paths)).where(F.contains("value", F.lit(","))).select(F.input_file_name().alias("sample"), F.substring_index("value", ",", 1).alias("name"), F.trim(F.substring_index("value", ",", -1)).alias("value"))


def read_aligner_log(spark: SparkSession, *paths: str) -> DataFrame:
    """file, input_reads, unique_reads, multi_reads of aligner logs."""
    text = spark.read.text(list(paths), wholetext=True)

    def number(label: str):
        return F.regexp_extract("value", rf"{label} \|\s*([0-9]+)", 1).try_cast("long")

    return text.select(F.input_file_name().alias("file"), number("Number of input reads").alias("input_reads"), number("Uniquely mapped reads number").alias("unique_reads"), number("Number of reads mapped to multiple loci").alias("multi_reads"))
