"""Single reads with known outcomes, and column functions against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from plexwell.functions import driver
from plexwell.functions import sequences as S
from plexwell.operators import barcodes
from plexwell.operators.quality_control import QcRules, quality_control, slice_read1

C = "AGCTACGTAGTAGCAGCTAGCATAGCTAGCTAGTCGATCGATCGTACGTAGCTAGCATGCTAGCTAGCTAGCTAGCTAATCTACGTACAA"
RULES = {"min_length": 20, "min_quality": 20, "min_umi_bases": 6, "homopolymer": 10, "max_at": 0.9, "max_gc": 0.9}
GOOD = "F" * 90


def run(spark, cdna=C, qual=None, umiqual="F" * 12, **rules):
    row = [("r", "TTGTAAGATCTTAGGC", cdna, qual or "F" * len(cdna), "CATACGACTGCA", umiqual)]
    frame = spark.createDataFrame(row, "name string, bcseq string, cdna_seq string, cdna_qual string, umiseq string, umiqual string")
    r = quality_control(frame, QcRules(**RULES | rules)).first()
    return r["qc"], len(r["cdna_seq"])


def test_outcomes(spark):
    assert run(spark) == ("PASS", 90)
    assert run(spark, C[:15] + "A" * 12 + C[27:]) == ("FAIL_HOMOPOLYMER", 90)
    assert run(spark, C[:45] + "G" * 12 + C[57:]) == ("PASS", 45)
    assert run(spark, C[:19]) == ("FAIL_LENGTH", 19)
    assert run(spark, qual="F" * 10 + "*" * 80) == ("FAIL_QUALITY_TRIMMING", 90)
    assert run(spark, qual="F" * 50 + "*" * 40) == ("PASS", 50)
    assert run(spark, umiqual="F" * 5 + "*" * 7) == ("FAIL_UMI_QUALITY", 90)
    assert run(spark, adapter="CAGCTAGCATAGCTAG") == ("FAIL_ADAPTER_TRIMMING", 90)
    assert run(spark, adapter="CTAGTCGATCGATCGT") == ("PASS", 28)
    assert run(spark, C.translate(str.maketrans("GC", "AT"))) == ("FAIL_AT_CONTENT", 90)


def cut_python(seq, qual, least=20):
    s = top = 0
    at = len(seq)
    for i in range(len(seq) - 1, -1, -1):
        s += least - (least - 1 if seq[i] == "G" else ord(qual[i]) - 33)
        if s < 0:
            break
        if s > top:
            top, at = s, i
    return at


def adapter_python(seq, adapter):
    m, n = len(adapter), len(seq)
    cost = lambda a, b: sum(x != y and x != "N" for x, y in zip(a, b, strict=True))
    full = [cost(seq[i : i + m], adapter) for i in range(n - m + 1)]
    if 0 in full:
        return full.index(0)
    if n >= m - 1 and cost(seq[: m - 1], adapter[1:]) == 0:
        return 0
    if 1 in full:
        return max(i for i, c in enumerate(full) if c == 1)
    for k in range(m - 1, 4, -1):
        if n >= k and cost(seq[n - k :], adapter[:k]) <= 1:
            return n - k
    return None


def test_cuts_equal_python(spark):
    rng = random.Random(3)
    adapter, rows = "AGATCGGA", []
    for _ in range(1500):
        seq = "".join(rng.choice("ACGT" * 5 + "N") for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.7:
            a = list(adapter[rng.randint(0, 1) :] if rng.random() < 0.2 else adapter)
            if rng.random() < 0.5:
                a[rng.randrange(len(a))] = rng.choice("ACGTN")
            k = rng.randint(0, len(seq))
            seq = (seq[:k] + "".join(a) + seq[k:])[: rng.randint(k, k + 40)]
        rows.append((seq, "".join(chr(33 + rng.randint(5, 36)) for _ in seq)))
    df = spark.createDataFrame(rows, "s string, q string")
    got = df.select("s", "q", S.adapter_at(F.col("s"), adapter).alias("a"), S.quality_cut(F.col("s"), F.col("q"), 20).alias("c")).collect()
    for r in got:
        assert r["a"] == adapter_python(r["s"], adapter), r["s"]
        assert r["c"] == cut_python(r["s"], r["q"]), r["s"]


def test_masks(spark):
    r = spark.createDataFrame([("ACGTNRYVBX=",)], "s string").select(S.iupac_masks(F.col("s")).alias("m")).first()
    assert r["m"] == [1, 2, 4, 8, 15, 5, 10, 7, 14, 15, 0]


WELLS = ["AACCGGTTAACCGGTT", "ACGTACGTACGTACGT", "TTTTCCCCAAAAGGGG", "GGCGTTTCGTCAGAAG"]


def whitelist(spark, seqs=WELLS):
    return spark.createDataFrame([(k, s, f"w{k}", False) for k, s in enumerate(seqs)], "bc_idx int, seq string, well string, mask boolean")


@pytest.mark.parametrize("limit", [barcodes.MAX_NEIGHBOURS, 0])
def test_matching_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(barcodes, "MAX_NEIGHBOURS", limit)
    reads = ["AACCGGTTAACCGGTT", "AACCGGTTAACCGGTA", "AACCGGTTAACCGGAA", "GGCGTTTCGTNAGAAG", "GGCGTTTCNTNAGAAG", None, "AACC"]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(reads)], "k int, bcseq string")
    got = {r["k"]: (r["bc_idx"], r["bm"]) for r in barcodes.match_barcodes(df, whitelist(spark)).collect()}
    assert got == {0: (0, 0), 1: (0, 1), 2: (-1, -1), 3: (3, 0), 4: (-1, -1), 5: (-1, -1), 6: (-1, -1)}
    tie = barcodes.match_barcodes(spark.createDataFrame([("AAAC",)], "bcseq string"), whitelist(spark, ["AAAG", "AAAA", "AAAT"]))
    assert tie.first()["bc_idx"] == 0
    codes = barcodes.match_barcodes_iupac(spark.createDataFrame([("RAAG",), ("NAAG",)], "bcseq string"), whitelist(spark, ["GAAG", "TTTT"]), 0)
    assert {r["bc_idx"] for r in codes.collect()} == {0}


def test_collisions_and_slices(spark):
    found = barcodes.whitelist_collisions(whitelist(spark, ["AAAA", "AAAT", "GGGG"]), 1).collect()
    assert [(r["bc_a"], r["bc_b"], r["distance"]) for r in found] == [(0, 1, 1)]
    pairs = spark.createDataFrame([("r", "ACGTTT", "ABCDEF")], "name string, r1_seq string, r1_qual string")
    assert slice_read1(pairs, 4, 2).select("bcseq", "umiseq", "umiqual").first() == ("ACGT", "TT", "EF")
    with pytest.raises(Exception, match="too short"):
        slice_read1(pairs, 6, 2).collect()


def test_driver_helpers():
    assert driver.quote_arguments(["a", "b c"]) == 'a "b c"'
    assert driver.genome_index_sizes(3_000_000_000, 25) == (14, 18)
