"""Matching reads to wells: nearest barcodes within a few mismatches, plate layouts and plate maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexwell.functions.sequences import count_of, hamming, iupac_mismatches, mismatches

#: Neighbour sequences of a whitelist up to which matching is an equi-join on them.
MAX_NEIGHBOURS = 2_000_000
#: Wells a broadcast whitelist may have (a plate has 96 to 1,536).
MAX_BROADCAST_WELLS = 20_000


def _neighbour_count(wells: int, length: int, rounds: int) -> int:
    from math import comb

    return wells * sum(comb(length, k) * 4**k for k in range(rounds + 1))


def neighbours(whitelist: DataFrame, length: int, rounds: int) -> DataFrame:
    """Every sequence that differs from a barcode at up to ``rounds`` places, N among the letters: near, bc_idx, seq."""
    out = whitelist.select(F.col("seq").alias("near"), "bc_idx", "seq")
    for _ in range(rounds):
        places = out.withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(length)))).withColumn("b", F.explode(F.array(*map(F.lit, "ACGTN"))))
        out = places.select(F.overlay("near", "b", "p", F.lit(1)).alias("near"), "bc_idx", "seq").distinct()
    return out


def match_barcodes(reads: DataFrame, whitelist: DataFrame, mismatch: int = 1, max_n: int = 1, bcseq: str = "bcseq") -> DataFrame:
    """``reads`` with bc_idx and bm (mismatches): the nearest barcode, the lowest index on ties; -1 and -1 for none.

    N matches any base; a read barcode with more than ``max_n`` of them matches none. Where the sequences within reach
    of the whitelist are few enough, they are listed once and reads find theirs by equality: a hash lookup, whatever the
    number of reads. Else distinct barcodes meet the broadcast whitelist (its size is checked). Barcodes are letters ACGT;
    ``match_barcodes_iupac`` takes others.
    """
    length, wells = whitelist.agg(F.max(F.length("seq")), F.count("*")).first()
    cost = mismatches(F.col("near"), F.col("seq"), length or 0) if length else F.lit(0)
    rounds = mismatch + max_n
    best = F.min(F.struct("cost", "bc_idx")).alias("best")
    if wells and _neighbour_count(wells, length, rounds) <= MAX_NEIGHBOURS:
        close = neighbours(whitelist, length, rounds).withColumn("cost", cost).where(F.col("cost") <= mismatch)
        found = close.groupBy("near").agg(best)
    else:
        if wells > MAX_BROADCAST_WELLS:
            raise ValueError(f"a whitelist of {wells} barcodes needs fewer mismatches than {mismatch}")
        seen = reads.select(F.col(bcseq).alias("near")).distinct()
        found = seen.crossJoin(F.broadcast(whitelist.select("bc_idx", "seq"))).withColumn("cost", cost).where(F.col("cost") <= mismatch).groupBy("near").agg(best)
    found = found.where(count_of(F.col("near"), "N") <= max_n).select("near", F.col("best.bc_idx").alias("bc_idx"), F.col("best.cost").alias("bm"))
    met = reads.join(found, reads[bcseq] == found["near"], "left")
    return met.select(*(reads[c] for c in reads.columns), F.coalesce("bc_idx", F.lit(-1)).cast("int").alias("bc_idx"), F.coalesce("bm", F.lit(-1)).cast("int").alias("bm"))


def match_barcodes_iupac(reads: DataFrame, whitelist: DataFrame, mismatch: int = 1, max_n: int = 1, bcseq: str = "bcseq") -> DataFrame:
    """As ``match_barcodes``, with IUPAC codes on both sides; distinct barcodes meet the broadcast whitelist."""
    if whitelist.count() > MAX_BROADCAST_WELLS:
        raise ValueError("the whitelist is too large")
    seen = reads.select(F.col(bcseq).alias("near")).distinct().where(count_of(F.col("near"), "N") <= max_n)
    cost = iupac_mismatches(F.col("near"), F.col("seq"))
    found = (
        seen.crossJoin(F.broadcast(whitelist.select("bc_idx", "seq"))).where(F.length("near") == F.length("seq")).withColumn("cost", cost)
        .where(F.col("cost") <= mismatch).groupBy("near").agg(F.min(F.struct("cost", "bc_idx")).alias("best"))
        .select("near", F.col("best.bc_idx").alias("bc_idx"), F.col("best.cost").alias("bm"))
    )
    met = reads.join(found, reads[bcseq] == found["near"], "left")
    return met.select(*(reads[c] for c in reads.columns), F.coalesce("bc_idx", F.lit(-1)).cast("int").alias("bc_idx"), F.coalesce("bm", F.lit(-1)).cast("int").alias("bm"))


def whitelist_collisions(whitelist: DataFrame, mismatch: int) -> DataFrame:
    """Pairs of barcodes within twice ``mismatch``: bc_a, bc_b, distance. A whitelist is one plate's barcodes."""
    a = whitelist.select(F.col("bc_idx").alias("bc_a"), F.col("seq").alias("seq_a"))
    b = whitelist.select(F.col("bc_idx").alias("bc_b"), F.col("seq").alias("seq_b"))
    return a.join(b, F.col("bc_a") < F.col("bc_b")).select("bc_a", "bc_b", iupac_mismatches(F.col("seq_a"), F.col("seq_b")).alias("distance")).where(F.col("distance") <= 2 * mismatch)


def layout_cells(lines: DataFrame) -> DataFrame:
    """Cells (y, x, seq; from 1) of a plate layout given as rows (y, value) of comma-separated barcodes."""
    return lines.select("y", F.posexplode(F.split("value", ",")).alias("p", "seq")).select("y", (F.col("p") + 1).alias("x"), "seq")


def layout_missing(whitelist: DataFrame, layout: DataFrame) -> DataFrame:
    """Barcodes of a plate that its layout lacks."""
    return whitelist.join(layout, "seq", "left_anti").select("bc_idx", "seq")


def resolve_unmatched(unmatched: DataFrame, layout: DataFrame, wells: DataFrame, mismatch: int) -> DataFrame:
    """seq, count, y, x, distance of unmatched barcodes that layout places without a well explain.

    ``unmatched``: seq, count; ``layout``: y, x, seq by place; ``wells``: y, x in use. Plain Hamming distance, the first
    place on ties. A layout is one plate.
    """
    free = layout.where(F.col("seq") != "").join(wells.select("y", "x"), ["y", "x"], "left_anti").select("y", "x", F.col("seq").alias("cell"))
    near = unmatched.join(F.broadcast(free), F.length("seq") == F.length("cell")).withColumn("distance", hamming(F.col("seq"), F.col("cell"))).where(F.col("distance") <= mismatch)
    best = near.groupBy("seq", "count").agg(F.min(F.struct("distance", "y", "x")).alias("b"))
    return best.select("seq", "count", "b.y", "b.x", "b.distance")


def plate_map(well_counts: DataFrame, wells: DataFrame, unmatched: DataFrame, layout: DataFrame, mismatch: int) -> DataFrame:
    """y, x, well (null if none), count for every cell of the layout.

    ``well_counts``: well, count; ``wells``: well, y, x; ``unmatched``: seq, count.
    """
    own = wells.join(well_counts, "well").select("y", "x", "well", "count")
    found = resolve_unmatched(unmatched, layout, wells, mismatch).select("y", "x", F.lit(None).cast("string").alias("well"), "count")
    summed = own.unionByName(found).groupBy("y", "x").agg(F.max("well").alias("well"), F.sum("count").alias("count"))
    return layout.select("y", "x").join(summed, ["y", "x"], "left").select("y", "x", "well", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def plate_grid(cells: DataFrame, columns: int = 24) -> DataFrame:
    """A lettered row for each y, and its counts in numbered columns."""
    wide = cells.groupBy("y").pivot("x", list(range(1, columns + 1))).agg(F.sum("count"))
    return wide.select(F.chr(F.col("y") + 64).alias("row"), *(F.coalesce(F.col(f"`{k}`"), F.lit(0)).alias(str(k)) for k in range(1, columns + 1)))


def annotate(cells: DataFrame, masked: DataFrame) -> DataFrame:
    """A plate map in long form with the mask of each place (outer: places of either side stay)."""
    return cells.join(masked.select("y", "x", "mask"), ["y", "x"], "full_outer").select("y", "x", "well", "count", F.coalesce("mask", F.lit(False)).alias("mask"))


def well_label(well: Column) -> tuple[Column, Column, Column]:
    """Pool, coordinate and label of a name like Pool1_C2__label."""
    pattern = r"^(.*)_([A-Z]+[0-9]+)__(.*)$"
    return tuple(F.regexp_extract(well, pattern, k) for k in (1, 2, 3))
