"""Reads from alignments, their outcomes, and positional UMI deduplication."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse_reads(alignments: DataFrame) -> DataFrame:
    """One row a read of a well: bc_idx, qname, umi, qc_failed, is_mapped, assigned, places, genes, n_alignments.

    ``places``: distinct (chrom, strand, pos) of all alignments; ``genes``: the sorted union of their genes.
    """
    failed = F.col("qcfail") | F.coalesce(F.col("qc") != "PASS", F.lit(True))
    return alignments.groupBy("bc_idx", "qname").agg(
        F.min_by("umi", F.struct(~F.col("is_primary"), F.col("umi"))).alias("umi"),
        F.max(failed).alias("qc_failed"), F.max("is_mapped").alias("is_mapped"), F.max(F.coalesce(F.col("xs") == "Assigned", F.lit(False))).alias("assigned"),
        F.array_sort(F.collect_set(F.when(F.col("is_mapped"), F.struct("chrom", "strand", F.col("start").alias("pos"))))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("xt")))).alias("genes"), F.count_if("is_mapped").alias("n_alignments"),
    )


def outcome() -> Column:
    """What becomes of a read: the first of four that holds."""
    return F.when(F.col("qc_failed"), "QCFAIL").when(~F.col("is_mapped"), "UNMAPPED").when(~F.col("assigned"), "NOFEATURE").otherwise("PASSED")


def name_key(name: Column) -> Column:
    """Order of names in which runs of digits compare as numbers: each is led by its length.

    Leading zeros are dropped for comparison and the whole name decides between names that differ in nothing else.
    """
    stripped = F.regexp_replace(name, r"(?<![0-9])0+(?=[0-9])", "")
    padded = F.transform(
        F.regexp_extract_all(stripped, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1)),
        lambda p: F.when(p.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(p).cast("string"), 6, "0"), p)).otherwise(p),
    )
    return F.concat(F.array_join(padded, ""), F.lit("\0"), name)


def mark_exact_duplicates(reads: DataFrame) -> DataFrame:
    """duplicate for reads of one well with equal places and UMI: all but the first by name order."""
    w = Window.partitionBy("bc_idx", "places", "umi").orderBy(name_key(F.col("qname")))
    return reads.withColumn("duplicate", F.row_number().over(w) > 1)


def _islands(reads: DataFrame, lookback: int) -> DataFrame:
    """bc_idx, qname, island for each place of a read; places within ``lookback`` of one another share an island."""
    at = reads.select("bc_idx", "qname", F.explode("places").alias("p")).select("bc_idx", "qname", "p.chrom", "p.strand", "p.pos")
    w = Window.partitionBy("bc_idx", "chrom", "strand").orderBy("pos")
    spots = at.select("bc_idx", "chrom", "strand", "pos").distinct()  # a hot place is one row
    gap = F.coalesce(F.col("pos") - F.lag("pos").over(w) > lookback, F.lit(True))
    named = spots.withColumn("gap", gap).withColumn("n", F.sum(F.col("gap").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    island = named.select("bc_idx", "chrom", "strand", "pos", F.xxhash64("bc_idx", "chrom", "strand", "n").alias("island"))
    return at.join(island, ["bc_idx", "chrom", "strand", "pos"]).select("bc_idx", "qname", "island").distinct()


def _components(pairs: DataFrame, staging: str | None) -> DataFrame:
    """island, component: islands that one read spans are one; least labels spread until nothing changes."""
    several = pairs.groupBy("bc_idx", "qname").agg(F.collect_set("island").alias("all"), F.min("island").alias("least")).where(F.size("all") > 1)
    edges = several.select("least", F.explode("all").alias("island")).where("least <> island").distinct()
    edges = _checkpoint(edges.select(F.col("island").alias("u"), F.col("least").alias("v")), staging)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("hub")).select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), "m")
        small = large.join(low, F.col("u") == F.col("hub"))
        new = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        new = _checkpoint(new, staging)
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            return new.select(F.col("u").alias("island"), F.col("v").alias("component"))
        edges = new


def _checkpoint(df: DataFrame, staging: str | None) -> DataFrame:
    """Cut lineage in the shared folder the session names, or in ``staging`` where it names none."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        told = context.getConf().get("spark.checkpoint.dir") or staging
        if told is None:
            if context.master.split("[")[0] != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            import tempfile

            told = tempfile.mkdtemp(prefix="plexwell-")
        context.setCheckpointDir(told)
    return df.checkpoint()


def _similar(a: str, b: str, distance: int) -> bool:
    """Whether the edit distance is at most ``distance``."""
    if a == b:
        return True
    if distance <= 0 or abs(len(a) - len(b)) > distance:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > distance:
            return False
    return row[-1] <= distance


def _scan(lookback: int, distance: int):
    """The greedy scan of one component in name order: a read near a kept one with a similar UMI is its duplicate."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["key"].to_pylist(), group["bc_idx"].to_pylist(), group["qname"].to_pylist(), group["umi"].to_pylist(), group["places"].to_pylist(), strict=True), key=lambda r: r[0])
        kept: dict[tuple, list[tuple[str, str]]] = {}
        out = []
        for _, well, name, umi, places in rows:
            of = None
            for p in places:
                for pos in range(p["pos"] - lookback, p["pos"] + lookback + 1):
                    for other, other_name in kept.get((p["chrom"], p["strand"], pos), ()):
                        if _similar(umi, other, distance):
                            of = other_name
                            break
                    if of:
                        break
                if of:
                    break
            if of is None:
                for p in places:
                    kept.setdefault((p["chrom"], p["strand"], p["pos"]), []).append((umi, name))
            out.append((well, name, of))
        cols = list(zip(*out, strict=True))
        return pa.table({"bc_idx": pa.array(cols[0], pa.int32()), "qname": pa.array(cols[1], pa.string()), "dup_of": pa.array(cols[2], pa.string())})

    return run


def deduplicate(reads: DataFrame, lookback: int = 10, distance: int = 2, umi_length: int = 10, staging: str | None = None) -> DataFrame:
    """``reads`` (bc_idx, qname, umi, places ...) with duplicate and dup_of, by the greedy rule in name order.

    A read is a duplicate if at one of its places, within ``lookback``, a kept read of its well has a UMI within edit
    distance ``distance``. Exact copies fall away first; what is left is cut into components that no near places join, each
    scanned for itself, so a well is as parallel as its places are apart. Which kept read dup_of names is not defined
    where several would do; whether there is one is.
    """
    if distance > umi_length // 2:
        raise ValueError("the distance is more than half a UMI")
    w = Window.partitionBy("bc_idx", "places", "umi").orderBy("key")
    narrow = reads.select(F.col("bc_idx").cast("int").alias("bc_idx"), "qname", "umi", "places", name_key(F.col("qname")).alias("key"))
    # written once: five steps read it, and reads may stand for a long plan
    exact = _checkpoint(narrow.withColumns({"nth": F.row_number().over(w), "head": F.first("qname").over(w)}), staging)
    first = exact.where("nth = 1").select("bc_idx", "qname", "umi", "places", "key")
    pairs = _checkpoint(_islands(first, lookback), staging)
    labels = _components(pairs, staging)
    own = pairs.groupBy("bc_idx", "qname").agg(F.min("island").alias("island")).join(labels, "island", "left").select("bc_idx", "qname", F.coalesce("component", "island").alias("component"))
    scanned = (
        first.join(own, ["bc_idx", "qname"]).groupBy("bc_idx", "component")
        .applyInArrow(_scan(lookback, distance), "bc_idx int, qname string, dup_of string")
    )
    head = exact.select("bc_idx", "qname", F.when(F.col("nth") > 1, F.col("head")).alias("head"))
    marks = head.join(scanned, ["bc_idx", "qname"], "left").select("bc_idx", "qname", F.coalesce("head", "dup_of").alias("dup_of"))
    return reads.join(marks, ["bc_idx", "qname"], "left").withColumn("duplicate", F.col("dup_of").isNotNull())


def dedup_counters(reads: DataFrame) -> DataFrame:
    """The nine counters of each well; UMIs are not counted for noBC (-1). ``reads``: collapsed, with duplicate."""
    r = reads.withColumn("outcome", outcome())
    ok = F.col("outcome") == "PASSED"
    in_well = ok & (F.col("bc_idx") >= 0)
    fresh = in_well & ~F.coalesce("duplicate", F.lit(False))
    one = F.size("genes") == 1
    return r.groupBy("bc_idx").agg(
        F.count("*").alias("TOTAL"), F.count_if(F.col("outcome") == "QCFAIL").alias("DISCARD_QCFAIL"), F.count_if(F.col("outcome") == "UNMAPPED").alias("DISCARD_UNMAPPED"),
        F.count_if(F.col("outcome") == "NOFEATURE").alias("DISCARD_NOFEATURE"), F.count_if(ok).alias("PASSED_QC"), F.count_if(ok & (F.col("n_alignments") > 1)).alias("N_MULTIMAPPED"),
        F.count_if(fresh).alias("UMI_COUNTS"), F.count_if(in_well & one).alias("UNIQUE_COUNTS"), F.count_if(fresh & one).alias("UNIQUE_UMIS"),
    )


def unmapped_counts(alignments: DataFrame) -> DataFrame:
    """bc_idx, count of unmapped alignments that did not fail QC."""
    return alignments.where("not qcfail and not is_mapped").groupBy("bc_idx").agg(F.count("*").alias("count"))
