"""Deduplication, allocation, normalisation, reports, metadata and sources."""

import random
import struct
import gzip
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from plexwell.operators import allocation, dedup, intervals, metadata, reports, sampling, statistics
from plexwell.sources import alignments, fastq, sinks, tables


def near(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def naive(reads, lookback, distance):
    kept, out = defaultdict(list), {}
    for well, name, umi, places in sorted(reads, key=lambda r: int(r[1][1:])):
        dup = any(near(umi, u) <= distance for c, s, p in places for q in range(p - lookback, p + lookback + 1) for u in kept[well, c, s, q])
        if not dup:
            for c, s, p in places:
                kept[well, c, s, p].append(umi)
        out[well, name] = dup
    return out


@pytest.mark.parametrize(("lookback", "distance"), [(0, 0), (3, 1), (10, 2)])
def test_deduplication_equals_a_scan(spark, lookback, distance):
    rng = random.Random(lookback)
    reads = []
    for k in range(400):
        places = sorted({(rng.choice("ab"), rng.choice("+-"), rng.randint(0, 150)) for _ in range(rng.randint(1, 3))})
        reads.append((rng.randint(0, 3), f"r{k}", "".join(rng.choice("AC") for _ in range(6)), places))
    df = spark.createDataFrame(reads, "bc_idx int, qname string, umi string, places array<struct<chrom:string,strand:string,pos:long>>")
    got = {(r["bc_idx"], r["qname"]): r["duplicate"] for r in dedup.deduplicate(df, lookback, distance, 6).collect()}
    assert got == naive(reads, lookback, distance)


def test_name_order(spark):
    names = ["r10", "r9", "r09", "a2b10", "a2b9", "a10", "r1020", "r120"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(dedup.name_key(F.col("n"))).collect()]
    assert got == ["a2b9", "a2b10", "a10", "r09", "r9", "r10", "r120", "r1020"]


def counts(spark):
    unique = spark.createDataFrame([(0, "a", 3), (0, "b", 1), (1, "a", 2)], "bc_idx int, gene string, count long")
    sets = spark.createDataFrame([(0, ["a", "b"], 4), (0, ["c", "d"], 2), (2, ["a", "c"], 1)], "bc_idx int, genes array<string>, count long")
    return unique, sets


def test_allocation(spark):
    unique, sets = counts(spark)
    table = lambda f, **k: {(r["bc_idx"], r["gene"]): round(r["count"], 6) for r in f(unique, sets, **k).collect()}
    assert table(allocation.uniform) == {(0, "a"): 5, (0, "b"): 3, (0, "c"): 1, (0, "d"): 1, (1, "a"): 2, (2, "a"): 0.5, (2, "c"): 0.5}
    assert table(allocation.prop_unique)[0, "a"] == 6 and table(allocation.prop_unique)[0, "c"] == 1
    assert table(allocation.rescue)[0, "a"] == 3 + 4 * (3 + 2) / 8
    em = table(allocation.expectation_maximisation, iterations=1, max_diff=0.0)
    assert em[0, "a"] == round(3 + 4 * 5 / 8, 6) and em[1, "a"] == 2
    long = table(allocation.expectation_maximisation, iterations=500, max_diff=1e-9)
    assert abs(long[0, "a"] - 6) < 1e-4
    for f in allocation.STRATEGIES.values():
        assert abs(sum(table(f).values()) - 13) < 1e-3
    tiny = allocation.expectation_maximisation(unique, sets, small=1e9)
    assert all(r["count"] == r["count"] for r in tiny.collect())


def test_exon_union(spark):
    e = spark.createDataFrame([("g", 0, 9), ("g", 5, 14), ("g", 15, 20), ("g", 30, 31), ("h", 4, 4), ("g", 0, 9)], "gene string, start long, end long")
    assert {r["gene"]: r["length"] for r in intervals.effective_lengths(e).collect()} == {"g": 21, "h": 0}


def test_gene_assignment_equals_brute_force(spark):
    rng = random.Random(1)
    al = [(k, rng.choice("xy"), rng.choice("+-"), s := rng.randint(0, 9000), s + rng.randint(0, 300)) for k in range(300)]
    ex = [(rng.choice("xy"), rng.choice("+-"), s := rng.randint(0, 9000), s + rng.randint(0, 5000 if k == 0 else 400), f"g{k % 20}", None) for k in range(60)]
    a = spark.createDataFrame(al, "aln_id long, chrom string, strand string, start long, end long")
    e = spark.createDataFrame(ex, "chrom string, strand string, start long, end long, gene string, biotype string")
    for strandness in (0, 1, 2):
        for fraction in (0.0, 0.5):
            got = {r["aln_id"]: r["xt"] for r in intervals.assign_genes(a, e, strandness, fraction, width=512).collect()}
            for i, c, s, lo, hi in al:
                want = []
                for g in sorted({x[4] for x in ex}):
                    on = [x for x in ex if x[4] == g and x[0] == c and (strandness == 0 or (x[1] == s) == (strandness == 1))]
                    covered = len({p for x in on for p in range(max(lo, x[2]), min(hi, x[3]) + 1)})
                    if covered and covered >= fraction * (hi - lo + 1):
                        want.append(g)
                assert got[i] == want


def test_settings_of_downsampling(spark):
    assert sampling.resolve_settings(None, 0.5) == (0.5, 0.5) and sampling.resolve_settings(None, None) == (False, False)
    w = spark.createDataFrame([(0, "a", False), (1, "b", False), (2, "c", True)], "bc_idx int, well string, mask boolean")
    passing = spark.createDataFrame([(0, 100), (1, 10), (2, 50)], "bc_idx int, count long")
    total = spark.createDataFrame([(200,)], "reads long")
    plan = lambda t, d: {r["bc_idx"]: (r["limit"], r["fraction"]) for r in sampling.downsample_plan(passing, w, total, t, d).collect()}
    assert plan(False, False) == {0: (None, 1.0), 1: (None, 1.0), 2: (None, 0.0)}
    assert plan(0.25, True) == {0: (50, 0.5), 1: (50, 1.0), 2: (50, 0.0)}
    assert plan(40, 25) == {0: (40, 0.25), 1: (40, 1.0), 2: (40, 0.0)}
    assert plan(True, 0.3)[0] == (30, 0.3)


def test_policies(spark):
    found = spark.createDataFrame([("b",), ("a",)], "well string")
    assert statistics.enforce(found, "Outliers", "warn") == "Outliers: a, b" and statistics.enforce(found, "x", "ignore") == ""
    with pytest.raises(ValueError, match="Outliers"):
        statistics.enforce(found, "Outliers", "raise")


def test_metadata(spark):
    columns = ", ".join(f"{c} string" for c in metadata.REQUIRED)
    good = spark.createDataFrame([("P", "L", "i", "A1", "ACG", "n", "G", "1"), ("P", "L", "i", "B2", "ACT", "n", "G", "2")], columns)
    assert metadata.violations(good).count() == 0
    assert [(r["x"], r["y"]) for r in metadata.coordinates(good).orderBy("x").collect()] == [(1, 1), (2, 2)]
    assert {r["rule"] for r in metadata.violations(good.drop("Plate")).collect()} == {"missing"}
    bad = good.union(spark.createDataFrame([("P", "L", "i2", "A1", "A C", "n", "G", "3")], columns))
    assert {(r["rule"], r["column"]) for r in metadata.violations(bad).collect()} == {("format", "WellBarcode"), ("unique", "Well_Index"), ("single", "Pool_Index_i7")}
    old = good.drop("Genome").withColumn("Species", F.when(F.col("SampleID") == "1", "Human").otherwise("Yeti"))
    assert {r["Genome"] for r in metadata.with_genome(old).collect()} == {"GRCh38", "Unknown__Yeti"}
    for wrong in ({"umi_length": 5}, {"strandness": 3}, {"strategies": ("Guess",)}, {"umi_length": 0}):
        with pytest.raises(ValueError):
            metadata.Parameters(**wrong)


def test_summaries(spark):
    rows = [("a", "Number of Reads", "10"), ("b", "Number of Reads", "30"), ("a", "Mapped", "0.5"), ("b", "Mapped", "0.9"), ("a", "Multi", "NoMulti"), ("b", "Multi", "0.4")]
    got = {r["name"]: r["value"] for r in reports.merge_summaries(spark.createDataFrame(rows, "sample string, name string, value string")).collect()}
    assert got["Number of Reads"] == 40 and abs(got["Mapped"] - 0.8) < 1e-12 and abs(got["Multi"] - 0.3) < 1e-12


def test_text_sources(spark, tmp_path):
    (tmp_path / "w.txt").write_text("ACGT\tw1\t1\t1\tTrue\nAAAA\tw2\t2\t1\tFalse\n")
    assert [tuple(r) for r in tables.read_whitelist(spark, str(tmp_path / "w.txt")).orderBy("bc_idx").collect()] == [(0, "ACGT", "w1", 1, 1, True), (1, "AAAA", "w2", 2, 1, False)]
    (tmp_path / "l.csv").write_text("ACGT,,AAAA\n,CC,\n")
    assert {(r["y"], r["x"]): r["seq"] for r in tables.read_layout(spark, str(tmp_path / "l.csv")).collect()} == {(1, 1): "ACGT", (1, 2): "", (1, 3): "AAAA", (2, 1): "", (2, 2): "CC", (2, 3): ""}
    (tmp_path / "s.csv").write_text("[Header]\nx,1\n[Data]\nSample_ID,index\na,ACG\nb,TTT\n")
    assert [tuple(r) for r in tables.read_sample_sheet(spark, str(tmp_path / "s.csv"), ("index",)).collect()] == [("a", "ACG"), ("b", "TTT")]
    (tmp_path / "g.gtf").write_text('#c\nchr1\tx\texon\t11\t20\t.\t+\t.\tgene_id "g1"; exon_number 2; gene_biotype "rRNA";\nchr1\tx\tgene\t1\t30\t.\t+\t.\tgene_id "g1";\n')
    r = tables.exons_of(tables.read_gtf(spark, str(tmp_path / "g.gtf"), "exon")).first()
    assert tuple(r) == ("chr1", "+", 10, 19, "g1", "rRNA")
    c = spark.createDataFrame([(0, "g2", 3), (1, "g1", 5)], "bc_idx int, gene string, count long")
    sinks.write_matrix(c, [("g1", "G1"), ("g2", "G2")], ["AC", "GT"], str(tmp_path / "m"))
    assert (tmp_path / "m/matrix.mtx").read_text() == "%%MatrixMarket matrix coordinate integer general\n2 2 2\n2 1 3\n1 2 5\n"
    sinks.write_matrix(c, [("g1", "G1"), ("g2", "G2")], ["AC", "GT"], str(tmp_path / "n"))
    got = tables.read_matrix_market(spark, str(tmp_path / "m/matrix.mtx"), str(tmp_path / "n/matrix.mtx")).collect()
    assert {tuple(r) for r in got} == {(1, 0, 6.0), (0, 1, 10.0)}


def test_fastq(spark, tmp_path):
    one, two = tmp_path / "P_S1_L001_R1_001.fastq.gz", tmp_path / "P_S1_L001_R2_001.fastq.gz"
    with gzip.open(one, "wt") as a, gzip.open(two, "wt") as b:
        for k in range(3):
            a.write(f"@r{k} x\nACGTAC\n+\nFFFFFF\n")
            if k < 2:
                b.write(f"@r{k} y\nTTTT\n+\nF*F*\n")
    pairs = fastq.find_pairs([str(one), str(two), str(tmp_path / "Undetermined_S0_L001_R1_001.fastq.gz")])
    assert pairs == [("P_S1_L001", str(one), str(two))]
    got = fastq.read_pairs(spark, [str(one)], [str(two)]).orderBy("name").collect()
    assert [tuple(r) for r in got] == [(0, f"r{k}", "ACGTAC", "FFFFFF", "TTTT", "F*F*") for k in range(2)]


def test_sam_and_bam(spark, tmp_path):
    sam = tmp_path / "a.sam"
    sam.write_text("@HD\tVN:1.6\nr1\t16\tchr1\t11\t255\t3M2D1M\t*\t0\t0\tACGT\tFFFF\tBI:i:3\tXS:Z:Assigned\tXT:Z:g1,g2\tQC:Z:PASS\tUB:Z:ACG\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tFF\n")
    r1, r2 = alignments.tagged(alignments.read_alignments(spark, str(sam))).orderBy("qname").collect()
    assert (r1["bc_idx"], r1["start"], r1["end"], r1["strand"], r1["xt"], r1["umi"], r1["is_mapped"]) == (3, 10, 15, "-", ["g1", "g2"], "ACG", True)
    assert (r2["bc_idx"], r2["start"], r2["is_mapped"]) == (-1, None, False)
    name, seq = b"r1\0", bytes([0x12, 0x48])
    body = struct.pack("<iiBBHHHiiii", 0, 10, len(name), 255, 0, 1, 0, 4, -1, -1, 0) + name + struct.pack("<I", 4 << 4) + seq + bytes([37] * 4) + b"BIC\x03" + b"UBZAC\0" + b"ZZBc" + struct.pack("<I2b", 2, 1, -1)
    raw = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000) + struct.pack("<i", len(body)) + body
    (tmp_path / "a.bam").write_bytes(gzip.compress(raw))
    r = alignments.read_alignments(spark, str(tmp_path / "a.bam")).first()
    assert (r["qname"], r["chrom"], r["start"], r["end"], r["seq"], r["qual"]) == ("r1", "chr1", 10, 13, "ACGT", "FFFF")
    assert r["tags"] == {"BI": "3", "UB": "AC", "ZZ": "1,-1"}
