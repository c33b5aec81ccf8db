"""SAM and BAM as a data source, and SAM text as a sink.

Rows: qname, flag, chrom, start (from 0), end (of the last base), strand, mapq, seq, qual, tags (map of texts). A file is one
partition; give one a well or lane. ``tagged`` adds the columns that deduplication takes from tags.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import open_binary

SCHEMA = "qname string, flag int, chrom string, start long, end long, strand string, mapq int, seq string, qual string, tags map<string,string>"
BATCH = 10_000
_BASES = "=ACMGRSVTWYHKDBN"
_CIGAR = re.compile(rb"(\d+)([MIDNSHP=X])")
_SIZES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def _row(name, flag, chrom, start, span, mapq, seq, qual, tags):
    mapped = not flag & 4
    return (name, flag, chrom if mapped else None, start if mapped else None, start + max(span, 1) - 1 if mapped else None, ("-" if flag & 16 else "+") if mapped else None, mapq, seq, qual, list(tags.items()))


def sam_rows(stream) -> Iterator[tuple]:
    for line in stream:
        if line.startswith(b"@") or not line.strip():
            continue
        f = line.rstrip(b"\r\n").split(b"\t")
        span = sum(int(n) for n, op in _CIGAR.findall(f[5]) if op in b"MDN=X")
        tags = {}
        for t in f[11:]:
            key, _, value = t.decode().split(":", 2)
            tags[key] = value
        yield _row(f[0].decode(), int(f[1]), f[2].decode(), int(f[3]) - 1, span, int(f[4]), f[9].decode(), f[10].decode(), tags)


def _tags(raw: bytes) -> dict[str, str]:
    out, at = {}, 0
    while at < len(raw):
        key, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(0, at)
            out[key], at = raw[at:end].decode(), end + 1
        elif kind == "A":
            out[key], at = chr(raw[at]), at + 1
        elif kind == "B":
            sub, n = _SIZES[chr(raw[at])], struct.unpack_from("<I", raw, at + 1)[0]
            size = struct.calcsize(sub) * n
            out[key], at = ",".join(map(str, struct.unpack_from(f"<{n}{sub}", raw, at + 5))), at + 5 + size
        else:
            code = "<" + _SIZES[kind]
            out[key], at = str(struct.unpack_from(code, raw, at)[0]), at + struct.calcsize(code)
    return out


def bam_rows(stream) -> Iterator[tuple]:
    if stream.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    stream.read(struct.unpack("<i", stream.read(4))[0])
    chroms = []
    for _ in range(struct.unpack("<i", stream.read(4))[0]):
        n = struct.unpack("<i", stream.read(4))[0]
        chroms.append(stream.read(n)[:-1].decode())
        stream.read(4)
    while size := stream.read(4):
        body = stream.read(struct.unpack("<i", size)[0])
        chrom, pos, n_name, mapq, _, n_cigar, flag, n_seq = struct.unpack_from("<iiBBHHHi", body)
        at = 32 + n_name
        name = body[32 : at - 1].decode()
        ops = struct.unpack_from(f"<{n_cigar}I", body, at)
        at += 4 * n_cigar
        seq = "".join(_BASES[b >> 4] + _BASES[b & 15] for b in body[at : at + (n_seq + 1) // 2])[:n_seq]
        at += (n_seq + 1) // 2
        qual = body[at : at + n_seq]
        text = "*" if qual[:1] == b"\xff" else bytes(q + 33 for q in qual).decode()
        span = sum(op >> 4 for op in ops if op & 15 in (0, 2, 3, 7, 8))
        yield _row(name, flag, chroms[chrom] if chrom >= 0 else "*", pos, span, mapq, seq, text, _tags(body[at + n_seq :]))


class Alignments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "alignments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "AlignmentReader":
        return AlignmentReader(self.options["paths"].split(","))


class AlignmentReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()))
        names = ("qname", "flag", "chrom", "start", "end", "strand", "mapq", "seq", "qual", "tags")
        with open_binary(partition.value) as stream:
            rows = (bam_rows if partition.value.endswith(".bam") else sam_rows)(stream)
            while part := list(islice(rows, BATCH)):
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names=names)


def read_alignments(spark: SparkSession, *paths: str) -> DataFrame:
    spark.dataSource.register(Alignments)
    return spark.read.format("alignments").option("paths", ",".join(paths)).load()


def tagged(alignments: DataFrame) -> DataFrame:
    """The columns of ``collapse_reads``: well index, UMI, outcome and genes from their tags."""

    def tag(k):
        return F.try_element_at("tags", F.lit(k))

    return alignments.select(
        F.coalesce(tag("BI").cast("int"), F.lit(-1)).alias("bc_idx"), "qname", F.coalesce(tag("UB"), tag("UR")).alias("umi"), tag("QC").alias("qc"),
        (F.col("flag").bitwiseAND(512) != 0).alias("qcfail"), (F.col("flag").bitwiseAND(0x900) == 0).alias("is_primary"), (F.col("flag").bitwiseAND(4) == 0).alias("is_mapped"),
        "chrom", "strand", "start", "end", "mapq", F.length("seq").alias("seq_length"), tag("XS").alias("xs"),
        F.coalesce(F.split(tag("XT"), "[,;]"), F.array().cast("array<string>")).alias("xt"),
    )


def sam_lines(reads: DataFrame) -> DataFrame:
    """Unaligned records (value) of demultiplexed reads with all their tags."""
    unmapped = F.when(F.col("qc") == "PASS", 4).otherwise(4 + 512)
    tags = [F.concat(F.lit(f"{t}:{k}:"), F.col(c).cast("string")) for t, k, c in (("CR", "Z", "bcseq"), ("UR", "Z", "umiseq"), ("UY", "Z", "umiqual"), ("BI", "i", "bc_idx"), ("BM", "i", "bm"), ("QC", "Z", "qc"))]
    return reads.select(F.concat_ws("\t", "name", unmapped.cast("string"), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("*"), F.lit("*"), F.lit("0"), F.lit("0"), "cdna_seq", "cdna_qual", *tags).alias("value"))
