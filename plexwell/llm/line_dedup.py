"""Line deduplication with DataFrame functions only.

Lines are exploded with their position, normalised (ASCII white space stripped, A-Z lower-cased) and hashed; documents
are counted for each hash, and a line that many documents hold stays only in the largest doc_id with it. Documents
are put together again from the positions that stay.

A null or empty text is one empty line. Rows with equal doc_id count as one document and are each put together for
themselves; a null doc_id is a document of its own that never is the largest. An empty table gives an empty table.
Only doc_id, the text and the columns of ``keep`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER_LETTERS, UPPER_LETTERS, Scratch

STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), UPPER_LETTERS, LOWER_LETTERS)


def dedup_lines(docs: DataFrame, keep: Sequence[str] = (), min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, ``keep``, text (of the lines that stay), n_lines (before), n_dropped of every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "line-dedup")
    whole = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("text"))
    told_apart = F.md5("text")  # rows of one doc_id with different texts have different positions
    hashes = F.transform(F.split("text", "\n", -1), lambda x: F.when(F.char_length(x) >= min_chars, line_key(x)))
    hashes = F.transform(hashes, lambda k: F.when(F.char_length(k) >= min_chars, F.unhex(F.md5(k))))
    lines = scratch.table(
        whole.select("doc_id", told_apart.alias("row"), F.posexplode(hashes).alias("pos", "hash")).where("hash is not null"), "lines"
    )
    # distinct (hash, document) first: its partial step and its key deal out even a line of every third document
    frequent = (
        lines.groupBy("hash", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("hash").agg(F.count("one").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs).select("hash", "keeper")
    )
    # written, so that both sides of the join are dealt for it alone and its large partitions can be split
    frequent = scratch.table(frequent, "frequent")
    drops = (
        lines.join(frequent, "hash").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drop"))
        .select(F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row"), "drop")
    )
    met = whole.withColumn("row", told_apart).join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("row") == F.col("drop_row")), "left")
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # split once (bound as s), then take the positions that stay: linear in the lines
    bound = F.array(F.struct(F.split("text", "\n", -1).alias("lines"), F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("drop")).alias("stay")))
    joined = F.transform(bound, lambda s: F.array_join(F.transform(s["stay"], lambda p: F.get(s["lines"], p)), "\n"))[0]
    return met.select(
        "doc_id", *keep, F.when(F.col("drop").isNull(), F.col("text")).otherwise(joined).alias("text"),
        n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL_OP7 = f"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), '{UPPER_LETTERS}', '{LOWER_LETTERS}') AS k FROM lines
), frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), decided AS (
  SELECT t.*, f.k IS NOT NULL AND t.doc_id <> f.keeper AS gone FROM keyed t LEFT JOIN frequent f ON t.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM decided GROUP BY doc_id
"""
