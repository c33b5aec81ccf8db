"""Paired FASTQ as a data source, and discovery of pairs.

``spark.read.format("paired_fastq").option("r1", "a,b").option("r2", "c,d").load()`` zips reads of each pair of files by position
and stops at the shorter one. A pair is one partition: compressed files can't be split; split large ones by lane or chunk
before (or give many pairs), and repartition after. Rows: pair, name, r1_seq, r1_qual, cdna_seq, cdna_qual.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import open_binary

SCHEMA = "pair int, name string, r1_seq string, r1_qual string, cdna_seq string, cdna_qual string"
BATCH = 20_000
_NAME = re.compile(r"(?:^|/)([^/]+?)((?:_S\d+)?(?:_L\d{3})?)_R([12])_[^/]*\.(?:fastq|fq)(?:\.gz)?$")


def records(stream: Iterable[bytes]) -> Iterator[tuple[str, str, str]]:
    """(name, sequence, qualities) of four-line records; the name ends at the first blank."""
    lines = iter(stream)
    while len(four := list(islice(lines, 4))) == 4:
        head, seq, plus, qual = (x.rstrip(b"\r\n").decode("ascii") for x in four)
        if not head.startswith("@") or not plus.startswith("+") or len(seq) != len(qual):
            raise ValueError(f"not a FASTQ record: {head[:80]}")
        yield head[1:].split(None, 1)[0] if len(head) > 1 else "", seq, qual


def find_pairs(paths: Iterable[str]) -> list[tuple[str, str, str]]:
    """(sample and lane, R1, R2) of file names with _R1_ and _R2_; undetermined reads are left out, a lone end is an error."""
    found: dict[str, dict[str, str]] = {}
    for path in sorted(paths):
        m = _NAME.search(path)
        if m and not m[1].startswith("Undetermined"):
            found.setdefault(m[1] + m[2], {})[m[3]] = path
    lone = [k for k, v in found.items() if len(v) != 2]
    if lone:
        raise ValueError(f"one end is missing: {lone}")
    return [(k, v["1"], v["2"]) for k, v in found.items()]


class PairedFastq(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paired_fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> "PairedFastqReader":
        return PairedFastqReader(self.options["r1"].split(","), self.options["r2"].split(","))


class PairedFastqReader(DataSourceReader):
    def __init__(self, first: list[str], second: list[str]):
        if len(first) != len(second):
            raise ValueError("as many files for either end are needed")
        self.pairs = list(zip(first, second, strict=True))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((k, *p)) for k, p in enumerate(self.pairs)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        k, a, b = partition.value
        with open_binary(a) as one, open_binary(b) as two:
            rows = ((k, x[0], x[1], x[2], y[1], y[2]) for x, y in zip(records(one), records(two), strict=False))
            while part := list(islice(rows, BATCH)):
                kinds = (pa.int32(), *(pa.string(),) * 5)
                cols = zip(*part, strict=True)
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in SCHEMA.split(", ")])


def read_pairs(spark: SparkSession, first: list[str], second: list[str]) -> DataFrame:
    spark.dataSource.register(PairedFastq)
    return spark.read.format("paired_fastq").option("r1", ",".join(first)).option("r2", ",".join(second)).load()
