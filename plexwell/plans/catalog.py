"""All queries of the library, and the SQL each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexwell.functions import sequences as S
from plexwell.operators import allocation, barcodes, dedup, intervals, metadata, normalization, reports, sampling, statistics
from plexwell.operators.quality_control import REASONS, QcRules, quality_control

from .views import ADAPTER, sql, view

RULES = QcRules(adapter=ADAPTER)
MISMATCH, MAX_N = 1, 1


def _matched(spark: SparkSession, d: str) -> DataFrame:
    return barcodes.match_barcodes(view(spark, d, "reads"), view(spark, d, "whitelist"), MISMATCH, MAX_N)


def _checked(spark: SparkSession, d: str) -> DataFrame:
    return quality_control(_matched(spark, d), RULES)


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    return intervals.assign_genes(view(spark, d, "alignments").where("is_mapped"), view(spark, d, "exons"), strandness=1)


def _collapsed(spark: SparkSession, d: str) -> DataFrame:
    a = view(spark, d, "alignments")
    genes = _assigned(spark, d).select("aln_id", "xs", "xt")
    full = a.join(genes, "aln_id", "left").withColumn("xt", F.coalesce("xt", F.array().cast("array<long>")))
    return dedup.collapse_reads(full)


def _exact(spark: SparkSession, d: str) -> DataFrame:
    """Collapsed reads; those that passed are marked as exact duplicates."""
    reads = _collapsed(spark, d).withColumn("outcome", dedup.outcome())
    own = reads.where("outcome = 'PASSED' and bc_idx >= 0")
    return dedup.mark_exact_duplicates(own).unionByName(reads.where("not (outcome = 'PASSED' and bc_idx >= 0)").withColumn("duplicate", F.lit(False)))


def _gene_reads(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "read_genes").groupBy("bc_idx", "read_id").agg(F.array_sort(F.collect_set("gene")).alias("genes")).withColumn("duplicate", F.lit(False))


def barcode_match(spark, d):
    return _matched(spark, d).select("read_id", "bc_idx", "bm")


def well_counts(spark, d):
    return statistics.well_counts(_matched(spark, d), view(spark, d, "whitelist"))


def mismatch_hist(spark, d):
    return statistics.mismatch_histogram(_matched(spark, d), view(spark, d, "whitelist"), MISMATCH)


def unmatched_top(spark, d):
    return statistics.unmatched_counts(_matched(spark, d))


def task_assignment(spark, d):
    return statistics.task_counts(_matched(spark, d), 25, 6)


def umi_quality_filter(spark, d):
    low = S.low_qualities(F.col("umiqual"), RULES.min_quality)
    return view(spark, d, "reads").select("read_id", low.cast("long").alias("low"), (low > RULES.min_umi_bases).alias("fails"))


def at_gc_filter(spark, d):
    n = F.length("cdna_seq")
    at, gc = S.count_of(F.col("cdna_seq"), "AT"), S.count_of(F.col("cdna_seq"), "CG")
    return view(spark, d, "reads").select("read_id", at.cast("long").alias("n_at"), gc.cast("long").alias("n_gc"), (at >= 0.9 * n).alias("at_fails"), (gc >= 0.9 * n).alias("gc_fails"))


def length_filter(spark, d):
    return view(spark, d, "reads").where(F.length("cdna_seq") >= RULES.min_length).select("read_id", F.length("cdna_seq").cast("long").alias("n"))


def homopolymer_trim(spark, d):
    return view(spark, d, "reads").select("read_id", S.homopolymer_at(F.col("cdna_seq"), RULES.homopolymer).cast("long").alias("cut"))


def fuzzy_homopolymer_trim(spark, d):
    return view(spark, d, "reads").select("read_id", S.fuzzy_homopolymer_at(F.col("cdna_seq"), 12, 1).cast("long").alias("cut"))


def adapter_trim(spark, d):
    return view(spark, d, "reads").select("read_id", S.adapter_at(F.col("cdna_seq"), ADAPTER).cast("long").alias("cut"))


def quality_trim(spark, d):
    return view(spark, d, "reads").select("read_id", S.quality_cut(F.col("cdna_seq"), F.col("cdna_qual"), RULES.min_quality).cast("long").alias("cut"))


def qc_reads(spark, d):
    return quality_control(view(spark, d, "reads"), RULES).select("read_id", "qc", F.length("cdna_seq").cast("long").alias("n"))


def qc_reason(spark, d):
    return statistics.reason_histogram(_checked(spark, d), view(spark, d, "whitelist"))


def merge_lane_stats(spark, d):
    reads = _matched(spark, d)
    lanes = [reads.where(F.col("lane") == k).groupBy("bc_idx").agg(F.count("*").alias("count")) for k in (0, 1)]
    return statistics.merge_lanes(*lanes, keys=["bc_idx"], values=["count"])


def read_genes_per_order(spark, d):
    """Orders by customer well: heavy-tailed counts for the heuristics."""
    return view(spark, d, "read_genes").groupBy("bc_idx").agg(F.count_if(F.col("gene") % 25 >= F.col("bc_idx")).alias("count"))


def _skewed(spark, d):
    wells = statistics.with_no_barcode(view(spark, d, "whitelist"))
    return wells.join(read_genes_per_order(spark, d), "bc_idx", "left").select("bc_idx", "well", F.coalesce(F.col("count") * F.when(F.col("bc_idx") == 1, 40).otherwise(1), F.lit(7)).alias("count"))


def iqr_outliers(spark, d):
    return statistics.iqr_outliers(_skewed(spark, d), view(spark, d, "whitelist"))


def fraction_outliers(spark, d):
    return statistics.fraction_outliers(_skewed(spark, d), view(spark, d, "whitelist"))


def failed_wells(spark, d):
    return statistics.failed_wells(qc_reason(spark, d), view(spark, d, "whitelist"), 0.62)


def count_quantiles(spark, d):
    return statistics.quantiles(_skewed(spark, d), "count", 0.25, 0.5, 0.75)


def whitelist_collision(spark, d):
    return barcodes.whitelist_collisions(view(spark, d, "whitelist"), 4)


def layout_missing(spark, d):
    return barcodes.layout_missing(view(spark, d, "whitelist"), view(spark, d, "layout"))


def plate_map(spark, d):
    reads, w = _matched(spark, d), view(spark, d, "whitelist").where("bc_idx % 7 <> 3")
    counts = statistics.well_counts(reads, w).select("well", "count")
    odd = view(spark, d, "reads").select(F.col("bcseq").alias("seq")).join(w, "seq", "left_anti").groupBy("seq").agg(F.count("*").alias("count"))
    layout = view(spark, d, "whitelist").select("y", "x", "seq")
    return barcodes.plate_map(counts, w.select("well", "y", "x"), odd, layout, 1)


def metadata_rules(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    k = F.col("n_nationkey")
    told = n.select(
        F.lit("P1").alias("Plate"), F.lit("Pool1").alias("PoolName"), F.when(k < 20, "i7a").otherwise("i7b").alias("Pool_Index_i7"), F.concat(F.chr(65 + k % 5), F.floor(k / 5).cast("string")).alias("Well_Index"),
        F.concat(F.lit("B"), (k % 24).cast("string")).alias("WellBarcode"), F.when(k == 3, "bad name!").otherwise(F.col("n_name")).alias("SampleName"), F.lit("GRCh38").alias("Genome"), k.cast("string").alias("SampleID"),
        F.when(k == 4, "7").when(k % 2 == 0, "1").alias("MaskWells"),
    )
    return metadata.violations(told)


def _plan(spark, d, threshold=True, target=True):
    reads = _checked(spark, d)
    passing = reads.where("qc = 'PASS' and bc_idx >= 0").groupBy("bc_idx").agg(F.count("*").alias("count"))
    return sampling.downsample_plan(passing, view(spark, d, "whitelist"), statistics.total_reads(reads), threshold, target)


def downsample_plan(spark, d):
    return _plan(spark, d, 0.02, True).withColumn("fraction", F.round("fraction", 9))


def downsample_apply(spark, d):
    return sampling.downsample(_checked(spark, d), _plan(spark, d, 0.02, 0.5), seed=7).select("read_id", "kept")


def gene_assign(spark, d):
    return _assigned(spark, d).select("aln_id", "xs", F.array_join(F.col("xt").cast("array<string>"), ",").alias("genes"))


def exon_union_length(spark, d):
    return intervals.effective_lengths(view(spark, d, "exons"))


def read_collapse(spark, d):
    r = _collapsed(spark, d)
    return r.select("bc_idx", "qname", "umi", dedup.outcome().alias("outcome"), F.size("places").cast("long").alias("n_places"), F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"), "n_alignments")


def umi_dedup_exact(spark, d):
    return _exact(spark, d).select("bc_idx", "qname", "duplicate")


def dedup_counters(spark, d):
    return dedup.dedup_counters(_exact(spark, d))


def umi_dedup(spark, d):
    reads = _collapsed(spark, d).where(dedup.outcome() == "PASSED").where("bc_idx >= 0")
    return dedup.deduplicate(reads, lookback=10, distance=2).select("bc_idx", "qname", "duplicate")


def unmapped_counts(spark, d):
    return dedup.unmapped_counts(view(spark, d, "alignments"))


def fragment_length(spark, d):
    return intervals.mean_fragment_length(view(spark, d, "alignments"))


def count_unique(spark, d):
    return allocation.count_unique(_gene_reads(spark, d))


def multigene_sets(spark, d):
    return allocation.count_sets(_gene_reads(spark, d)).select("bc_idx", F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"), "count")


def _allocated(strategy):
    def run(spark, d):
        reads = _gene_reads(spark, d)
        return strategy(allocation.count_unique(reads), allocation.count_sets(reads)).select("bc_idx", "gene", F.round("count", 6).alias("count"))

    return run


def matrix_sum(spark, d):
    reads = view(spark, d, "read_genes")
    rows = reads.groupBy("gene", "bc_idx", (F.col("read_id") % 3).alias("shard")).agg(F.count("*").alias("count")).drop("shard")
    return reports.merge_matrices(rows)


def _normal(f, column, fragment=False, excluded=False):
    def run(spark, d):
        counts = view(spark, d, "read_genes").groupBy("bc_idx", "gene").agg(F.count("*").alias("count"))
        exons = view(spark, d, "exons")
        wells = view(spark, d, "whitelist")
        shorter = wells.select("bc_idx", (F.col("bc_idx") * 20).alias("fragment_length")) if fragment else None
        out = f(counts, intervals.effective_lengths(exons), wells, shorter, normalization.ribosomal(exons).distinct() if excluded else None)
        return out.withColumn(column, F.round(column, 4))

    return run


def well_report(spark, d):
    reads, w = _checked(spark, d), view(spark, d, "whitelist")
    demux = statistics.reason_histogram(reads, w).join(statistics.well_counts(reads, w).select("bc_idx", F.col("count").alias("TOTAL_IN")), "bc_idx")
    kept = sampling.downsample(reads, _plan(spark, d, 0.02, 0.5), seed=7).where("kept").groupBy("bc_idx").agg(F.count("*").alias("out"))
    out = reports.well_report(demux, kept, unmapped_counts(spark, d), dedup_counters(spark, d))
    return out.select("bc_idx", "well", "TOTAL_IN", *(F.round(c, 6).alias(c) for c in out.columns if c.startswith("PCT_")), "FINAL_UMI", "DOWNSAMPLE_OUT", "UNMAP_COUNT", "DEDUP_TOTAL")


def position_quality(spark, d):
    return reports.per_position_quality(view(spark, d, "reads")).withColumn("mean_quality", F.round("mean_quality", 6))


def umi_similarity(spark, d):
    """Pairs of UMIs of neighbouring users that count as one molecule's."""
    u = view(spark, d, "reads").select("umiseq").distinct()
    a, b = u.select(F.col("umiseq").alias("a")), u.select(F.col("umiseq").alias("b"))
    # 40 molecules and their one-base variants: a set that does not grow with the reads
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", F.levenshtein("a", "b").alias("distance")).where("distance <= 2")


QUERIES = {
    f.__name__: f
    for f in (
        barcode_match, well_counts, mismatch_hist, unmatched_top, task_assignment, umi_quality_filter, at_gc_filter, length_filter, homopolymer_trim,
        fuzzy_homopolymer_trim, adapter_trim, quality_trim, qc_reads, qc_reason, merge_lane_stats, iqr_outliers, fraction_outliers, failed_wells, count_quantiles,
        whitelist_collision, layout_missing, plate_map, metadata_rules, downsample_plan, downsample_apply, gene_assign, exon_union_length, read_collapse,
        umi_dedup_exact, dedup_counters, umi_dedup, unmapped_counts, fragment_length, count_unique, multigene_sets, matrix_sum, well_report, position_quality, umi_similarity,
    )
}
QUERIES |= {
    "alloc_uniform": _allocated(allocation.uniform), "alloc_propunique": _allocated(allocation.prop_unique), "alloc_rescue": _allocated(allocation.rescue),
    "alloc_em": _allocated(allocation.expectation_maximisation), "tpm": _normal(normalization.tpm, "tpm"), "fpkm": _normal(normalization.fpkm, "fpkm"),
    "length_adjusted_tpm": _normal(normalization.tpm, "tpm", fragment=True), "tpm_without_rrna": _normal(normalization.tpm, "tpm", excluded=True),
}


# --- the same in SQL ---------------------------------------------------------------------------------------------------------


def _with(*parts: tuple[str, str]) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in parts) + " "


def _cost(a: str, b: str, n: int) -> str:
    return f"list_sum(list_transform(range(1, {n + 1}), lambda i: CASE WHEN substr({a}, i, 1) = substr({b}, i, 1) OR substr({a}, i, 1) = 'N' OR substr({b}, i, 1) = 'N' THEN 0 ELSE 1 END))"


_W, _R, _X, _A, _G = (("w", sql("whitelist")), ("r", sql("reads")), ("exons", sql("exons")), ("al", sql("alignments")), ("rg", sql("read_genes")))
_M = (
    ("seen", "SELECT DISTINCT bcseq FROM r WHERE length(bcseq) - length(replace(bcseq, 'N', '')) <= 1"),
    ("near", f"SELECT bcseq, bc_idx, {_cost('bcseq', 'seq', 16)} AS bm FROM seen CROSS JOIN w"),
    ("best", "SELECT bcseq, bc_idx, bm FROM near WHERE bm <= 1 QUALIFY row_number() OVER (PARTITION BY bcseq ORDER BY bm, bc_idx) = 1"),
    ("m", "SELECT r.*, coalesce(best.bc_idx, -1) AS bc_idx, coalesce(best.bm, -1) AS bm FROM r LEFT JOIN best ON r.bcseq = best.bcseq"),
    ("wn", "SELECT bc_idx, well, mask FROM w UNION ALL SELECT -1, 'noBC', false"),
)
_BAD = "".join(map(chr, range(33, 53))).replace("'", "''")


def _low(q: str) -> str:
    return f"(length({q}) - length(translate({q}, '{_BAD}', '')))"


def _hom(s: str) -> str:
    return f"least({', '.join(f'nullif(instr({s}, repeat({chr(39)}{b}{chr(39)}, 10)), 0)' for b in 'ACGTN')}) - 1"


def _adapter(s: str) -> str:
    m = len(ADAPTER)
    one = "CASE WHEN substr({s}, {i} + j + 1, 1) = substr('" + ADAPTER + "', j + 1 + {o}, 1) OR substr({s}, {i} + j + 1, 1) = 'N' THEN 0 ELSE 1 END"
    full = f"list_transform(range(0, greatest(length({s}) - {m} + 1, 0)), lambda i: list_sum(list_transform(range(0, {m}), lambda j: {one.format(s=s, i='i', o=0)})))"
    shifted = f"CASE WHEN length({s}) >= {m - 1} AND list_sum(list_transform(range(0, {m - 1}), lambda j: {one.format(s=s, i=0, o=1)})) = 0 THEN 0 END"
    hang = ", ".join(
        f"CASE WHEN length({s}) >= {k} AND list_sum(list_transform(range(0, {k}), lambda j: {one.format(s=s, i=f'(length({s}) - {k})', o=0)})) <= 1 THEN length({s}) - {k} END" for k in range(m - 1, 4, -1)
    )
    near = f"length({s}) - {m} - (nullif(coalesce(list_position(list_reverse({full}), 1), 0), 0) - 1)"
    return f"coalesce(nullif(coalesce(list_position({full}, 0), 0), 0) - 1, {shifted}, {near}, {hang})"


def _qcut(table: str) -> str:
    """read_id, cut of a table with read_id, s, q: the rightmost place of the greatest sum before the sum turns negative."""
    return f"""
    SELECT t.read_id, coalesce(c.cut, length(t.s)) AS cut FROM {table} t LEFT JOIN (
      SELECT read_id, arg_max(i - 1, (run, i)) AS cut FROM (
        SELECT read_id, i, run, min(run) OVER (PARTITION BY read_id ORDER BY i DESC) AS low FROM (
          SELECT read_id, i, sum(20 - v) OVER (PARTITION BY read_id ORDER BY i DESC) AS run FROM (
            SELECT read_id, i, CASE WHEN substr(s, i, 1) = 'G' THEN 19 ELSE ascii(substr(q, i, 1)) - 33 END AS v FROM (SELECT read_id, s, q, unnest(range(1, length(s) + 1)) AS i FROM {table}) u) v) x) y
      WHERE low >= 0 AND run > 0 GROUP BY read_id) c ON t.read_id = c.read_id"""


def _qc(source: str) -> tuple[tuple[str, str], ...]:
    """CTEs that end in qc: all columns of ``source``, qc, s (what is left of the read)."""
    return (
        ("q0", f"""SELECT *, length(cdna_seq) AS n0, CASE WHEN {_low("umiqual")} > 6 THEN 'FAIL_UMI_QUALITY'
            WHEN length(cdna_seq) - length(translate(cdna_seq, 'AT', '')) >= 0.9 * length(cdna_seq) THEN 'FAIL_AT_CONTENT'
            WHEN length(cdna_seq) - length(translate(cdna_seq, 'CG', '')) >= 0.9 * length(cdna_seq) THEN 'FAIL_GC_CONTENT' WHEN length(cdna_seq) < 20 THEN 'FAIL_LENGTH' END AS f0 FROM {source}"""),
        ("q1", f"SELECT *, CASE WHEN f0 IS NULL THEN {_hom('cdna_seq')} END AS c1 FROM q0"),
        ("q2", "SELECT *, coalesce(f0, CASE WHEN c1 < 20 THEN 'FAIL_HOMOPOLYMER' END) AS f1, CASE WHEN c1 >= 20 THEN substr(cdna_seq, 1, c1) ELSE cdna_seq END AS s1 FROM q1"),
        ("q3", f"SELECT *, CASE WHEN f1 IS NULL THEN {_adapter('s1')} END AS c2 FROM q2"),
        ("q4", "SELECT *, coalesce(f1, CASE WHEN c2 < 20 THEN 'FAIL_ADAPTER_TRIMMING' END) AS f2, CASE WHEN c2 >= 20 THEN substr(s1, 1, c2) ELSE s1 END AS s, cdna_qual AS q FROM q3"),
        ("q5", "SELECT read_id, s, q FROM q4 WHERE f2 IS NULL"),
        ("q6", _qcut("q5")),
        ("qc", "SELECT q4.* EXCLUDE (s), coalesce(f2, CASE WHEN q6.cut < 20 THEN 'FAIL_QUALITY_TRIMMING' END, 'PASS') AS qc, CASE WHEN q6.cut >= 20 THEN substr(s, 1, q6.cut) ELSE s END AS s FROM q4 LEFT JOIN q6 ON q4.read_id = q6.read_id"),
    )


_REASON = ("reason", "SELECT wn.bc_idx, wn.well, " + ", ".join(f"count(*) FILTER (WHERE qc.qc = '{r}') AS {r}" for r in REASONS) + " FROM wn LEFT JOIN qc ON wn.bc_idx = qc.bc_idx GROUP BY ALL")
_SKEW = ("sk", "SELECT wn.bc_idx, wn.well, coalesce(c.n * CASE WHEN wn.bc_idx = 1 THEN 40 ELSE 1 END, 7) AS count FROM wn LEFT JOIN (SELECT bc_idx, count(*) FILTER (WHERE gene % 25 >= bc_idx) AS n FROM rg GROUP BY bc_idx) c ON wn.bc_idx = c.bc_idx")
_SK = (_W, _G, _M[4], _SKEW)
_PLAN = (
    ("passing", "SELECT w.bc_idx, w.well, w.mask, count(qc.read_id) AS qc_pass_reads FROM w LEFT JOIN qc ON w.bc_idx = qc.bc_idx AND qc.qc = 'PASS' GROUP BY ALL"),
    ("plan", "SELECT bc_idx, well, mask, qc_pass_reads, CAST(round_even((SELECT count(*) FROM qc) * CAST(0.02 AS DOUBLE), 0) AS BIGINT) AS lim FROM passing"),
)
_KEPT = (
    ("kept", """SELECT qc.read_id, qc.bc_idx, qc.qc = 'PASS' AND CAST('0x' || substr(md5(qc.name || ':7'), 1, 7) AS BIGINT) < CASE WHEN plan.bc_idx IS NULL OR plan.mask THEN 0.0 WHEN qc_pass_reads <= lim THEN 1.0 ELSE 0.5 END * 268435456 AS kept
    FROM qc LEFT JOIN plan ON qc.bc_idx = plan.bc_idx"""),
)
_ASSIGN = ("hit", 'SELECT DISTINCT al.aln_id, x.gene FROM al JOIN exons x ON al.chrom = x.chrom AND al.strand = x.strand AND al.start <= x."end" AND x.start <= al."end" WHERE al.is_mapped')
_COLL = (
    _A, _X, _ASSIGN,
    ("g", "SELECT bc_idx, qname, list_sort(list_distinct(list(h.gene))) AS genes FROM al JOIN hit h ON al.aln_id = h.aln_id GROUP BY ALL"),
    ("coll", """SELECT al.bc_idx, al.qname, arg_min(umi, (NOT is_primary, umi)) AS umi, bool_or(qcfail OR qc <> 'PASS') AS qc_failed, bool_or(is_mapped) AS is_mapped,
        list_sort(list_distinct(list((chrom, strand, start)) FILTER (WHERE is_mapped))) AS places, count(*) FILTER (WHERE is_mapped) AS n_alignments FROM al GROUP BY al.bc_idx, al.qname"""),
    ("c", """SELECT coll.*, coalesce(g.genes, []) AS genes, CASE WHEN qc_failed THEN 'QCFAIL' WHEN NOT is_mapped THEN 'UNMAPPED' WHEN g.genes IS NULL THEN 'NOFEATURE' ELSE 'PASSED' END AS outcome
        FROM coll LEFT JOIN g ON coll.bc_idx = g.bc_idx AND coll.qname = g.qname"""),
    ("ex", """SELECT *, outcome = 'PASSED' AND bc_idx >= 0 AND row_number() OVER (PARTITION BY outcome = 'PASSED' AND bc_idx >= 0, bc_idx, places, umi ORDER BY CAST(substr(qname, 3) AS BIGINT)) > 1 AS duplicate FROM c"""),
    ("ded", """SELECT bc_idx, count(*) AS "TOTAL", count(*) FILTER (WHERE outcome = 'QCFAIL') AS "DISCARD_QCFAIL", count(*) FILTER (WHERE outcome = 'UNMAPPED') AS "DISCARD_UNMAPPED",
        count(*) FILTER (WHERE outcome = 'NOFEATURE') AS "DISCARD_NOFEATURE", count(*) FILTER (WHERE outcome = 'PASSED') AS "PASSED_QC", count(*) FILTER (WHERE outcome = 'PASSED' AND n_alignments > 1) AS "N_MULTIMAPPED",
        count(*) FILTER (WHERE outcome = 'PASSED' AND bc_idx >= 0 AND NOT duplicate) AS "UMI_COUNTS", count(*) FILTER (WHERE outcome = 'PASSED' AND bc_idx >= 0 AND len(genes) = 1) AS "UNIQUE_COUNTS",
        count(*) FILTER (WHERE outcome = 'PASSED' AND bc_idx >= 0 AND NOT duplicate AND len(genes) = 1) AS "UNIQUE_UMIS" FROM ex GROUP BY bc_idx"""),
)
_SETS = (
    _G, ("s", "SELECT bc_idx, read_id, list_sort(list(gene)) AS genes FROM rg GROUP BY ALL"),
    ("uq", "SELECT bc_idx, genes[1] AS gene, count(*) AS count FROM s WHERE len(genes) = 1 GROUP BY ALL"),
    ("st", "SELECT bc_idx, genes, count(*) AS count FROM s WHERE len(genes) > 1 GROUP BY ALL"),
    ("mem", "SELECT x.bc_idx, x.genes, x.gene, x.r, len(x.genes) AS k, coalesce(uq.count, 0) AS u FROM (SELECT bc_idx, genes, unnest(genes) AS gene, CAST(count AS DOUBLE) AS r FROM st) x LEFT JOIN uq ON x.bc_idx = uq.bc_idx AND x.gene = uq.gene"),
    ("tot", "SELECT *, sum(u) OVER (PARTITION BY bc_idx, genes) AS total FROM mem"),
)


def _alloc(share: str) -> str:
    return _with(*_SETS) + f"SELECT bc_idx, gene, round(sum(c), 6) AS count FROM (SELECT bc_idx, gene, CAST(count AS DOUBLE) AS c FROM uq UNION ALL SELECT bc_idx, gene, {share} FROM tot) x GROUP BY bc_idx, gene"


_LEN = (
    ("d", 'SELECT DISTINCT gene, start, "end" AS e FROM exons'),
    ("o", "SELECT *, CASE WHEN max(e) OVER (PARTITION BY gene ORDER BY start, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= start - 1 THEN 0 ELSE 1 END AS fresh FROM d"),
    ("b", "SELECT *, sum(fresh) OVER (PARTITION BY gene ORDER BY start, e) AS block FROM o"),
    ("len", "SELECT gene, sum(n) AS length FROM (SELECT gene, block, max(e) - min(start) AS n FROM b GROUP BY gene, block) x GROUP BY gene"),
)


def _norm(value: str, column: str, shorter: str = "0", counted: str = "true") -> str:
    grid = f"""SELECT w.bc_idx, len.gene, coalesce(c.n, 0) AS n, greatest(CAST(len.length AS DOUBLE) - {shorter}, 0) AS l, {counted} AS counted
        FROM w CROSS JOIN len LEFT JOIN (SELECT bc_idx, gene, count(*) AS n FROM rg GROUP BY ALL) c ON w.bc_idx = c.bc_idx AND len.gene = c.gene"""
    return _with(_W, _X, _G, *_LEN, ("grid", grid), ("rate", "SELECT *, CASE WHEN l > 0 THEN n / l END AS rate FROM grid")) + f"SELECT bc_idx, gene, round(coalesce({value}, 0), 4) AS {column} FROM rate"


_TPM = "rate * 1e6 / nullif(sum(rate) FILTER (WHERE counted) OVER (PARTITION BY bc_idx), 0)"
_PCT = "CASE WHEN {a} <> 0 THEN round(({a} - {b}) * 100.0 / {a}, 6) END AS PCT_LOSS_{n}"

SQL: dict[str, str] = {
    "barcode_match": _with(_W, _R, *_M) + "SELECT read_id, bc_idx, CAST(bm AS INT) AS bm FROM m",
    "well_counts": _with(_W, _R, *_M) + "SELECT wn.bc_idx, wn.well, count(m.read_id) AS count FROM wn LEFT JOIN m ON wn.bc_idx = m.bc_idx GROUP BY ALL",
    "mismatch_hist": _with(_W, _R, *_M) + "SELECT w.bc_idx, w.well, count(*) FILTER (WHERE bm = 0) AS mm_0, count(*) FILTER (WHERE bm = 1) AS mm_1 FROM w LEFT JOIN m ON w.bc_idx = m.bc_idx GROUP BY ALL",
    "unmatched_top": _with(_W, _R, *_M) + "SELECT bcseq AS seq, count(*) AS count FROM m WHERE bc_idx < 0 GROUP BY bcseq",
    "task_assignment": _with(_W, _R, *_M) + "SELECT CASE WHEN bc_idx < 0 THEN 6 ELSE CAST(floor(bc_idx * 6 / 25) AS INT) END AS task, count(*) AS count FROM m GROUP BY ALL",
    "merge_lane_stats": _with(_W, _R, *_M) + "SELECT bc_idx, count(*) AS count FROM m GROUP BY bc_idx",
    "umi_quality_filter": _with(_R) + f"SELECT read_id, {_low('umiqual')} AS low, {_low('umiqual')} > 6 AS fails FROM r",
    "at_gc_filter": _with(_R) + "SELECT read_id, a AS n_at, g AS n_gc, a >= 0.9 * n AS at_fails, g >= 0.9 * n AS gc_fails FROM (SELECT read_id, length(cdna_seq) AS n, length(cdna_seq) - length(translate(cdna_seq, 'AT', '')) AS a, length(cdna_seq) - length(translate(cdna_seq, 'CG', '')) AS g FROM r) x",
    "length_filter": _with(_R) + "SELECT read_id, length(cdna_seq) AS n FROM r WHERE length(cdna_seq) >= 20",
    "homopolymer_trim": _with(_R) + f"SELECT read_id, {_hom('cdna_seq')} AS cut FROM r",
    "fuzzy_homopolymer_trim": _with(_R) + "SELECT read_id, list_filter(range(0, greatest(length(cdna_seq) - 11, 0)), lambda i: greatest("
    + ", ".join(f"12 - length(replace(substr(cdna_seq, i + 1, 12), '{b}', ''))" for b in "ACGTN") + ") >= 11)[1] AS cut FROM r",
    "adapter_trim": _with(_R) + f"SELECT read_id, {_adapter('cdna_seq')} AS cut FROM r",
    "quality_trim": _with(_R, ("t0", "SELECT read_id, cdna_seq AS s, cdna_qual AS q FROM r")) + _qcut("t0"),
    "qc_reads": _with(_R, *_qc("r")) + "SELECT read_id, qc, length(s) AS n FROM qc",
    "qc_reason": _with(_W, _R, *_M, *_qc("m"), _REASON) + "SELECT * FROM reason",
    "failed_wells": _with(_W, _R, *_M, *_qc("m"), _REASON) + f"SELECT well, PASS, {' + '.join(REASONS)} AS count FROM reason WHERE well NOT IN (SELECT well FROM w WHERE mask) AND PASS < 0.62 * ({' + '.join(REASONS)})",
    "iqr_outliers": _with(*_SK, ("own", "SELECT sk.* FROM sk JOIN w ON sk.well = w.well WHERE NOT w.mask"), ("lim", "SELECT quantile_cont(count, 0.75) + 1.75 * (quantile_cont(count, 0.75) - quantile_cont(count, 0.25)) AS lim FROM own")) + 'SELECT well, count, lim AS "limit" FROM own, lim WHERE count > lim',
    "fraction_outliers": _with(*_SK, ("own", "SELECT * FROM sk WHERE well NOT IN (SELECT well FROM w WHERE mask)"), ("lim", "SELECT CAST(sum(count) AS DOUBLE) * CAST(0.15 AS DOUBLE) AS lim FROM own")) + 'SELECT well, count, lim AS "limit" FROM own, lim WHERE count > lim',
    "count_quantiles": _with(*_SK) + "SELECT quantile_cont(count, 0.25) AS q0, quantile_cont(count, 0.5) AS q1, quantile_cont(count, 0.75) AS q2 FROM sk",
    "whitelist_collision": _with(_W) + f"SELECT a.bc_idx AS bc_a, b.bc_idx AS bc_b, CAST({_cost('a.seq', 'b.seq', 16)} AS INT) AS distance FROM w a JOIN w b ON a.bc_idx < b.bc_idx WHERE {_cost('a.seq', 'b.seq', 16)} <= 8",
    "layout_missing": _with(_W, ("l", sql("layout"))) + "SELECT bc_idx, seq FROM w WHERE seq NOT IN (SELECT seq FROM l)",
    "plate_map": _with(
        _W, _R, *_M, ("own", "SELECT * FROM w WHERE bc_idx % 7 <> 3"), ("odd", "SELECT bcseq AS seq, count(*) AS n FROM r WHERE bcseq NOT IN (SELECT seq FROM own) GROUP BY bcseq"),
        ("free", "SELECT y, x, seq FROM w WHERE bc_idx % 7 = 3"),
        ("res", "SELECT odd.seq, odd.n, free.y, free.x, list_sum(list_transform(range(1, 17), lambda i: CASE WHEN substr(odd.seq, i, 1) = substr(free.seq, i, 1) THEN 0 ELSE 1 END)) AS dist FROM odd CROSS JOIN free"),
        ("pick", "SELECT * FROM res WHERE dist <= 1 QUALIFY row_number() OVER (PARTITION BY seq ORDER BY dist, y, x) = 1"),
        ("parts", "SELECT own.y, own.x, own.well, count(m.read_id) AS n FROM own LEFT JOIN m ON own.bc_idx = m.bc_idx GROUP BY ALL UNION ALL SELECT y, x, NULL, n FROM pick"),
    ) + "SELECT w.y, w.x, max(parts.well) AS well, CAST(coalesce(sum(parts.n), 0) AS BIGINT) AS count FROM w LEFT JOIN parts ON w.y = parts.y AND w.x = parts.x GROUP BY w.y, w.x",
    "metadata_rules": """WITH t AS (SELECT CASE WHEN n_nationkey < 20 THEN 'i7a' ELSE 'i7b' END AS "Pool_Index_i7", chr(CAST(65 + n_nationkey % 5 AS INT)) || CAST(n_nationkey // 5 AS STRING) AS "Well_Index", 'B' || CAST(n_nationkey % 24 AS STRING) AS "WellBarcode",
        CASE WHEN n_nationkey = 3 THEN 'bad name!' ELSE n_name END AS "SampleName", CASE WHEN n_nationkey = 4 THEN '7' WHEN n_nationkey % 2 = 0 THEN '1' END AS m FROM nation)
        SELECT 'format' AS rule, 'SampleName' AS "column", "SampleName" AS value, count(*) AS rows FROM t WHERE NOT regexp_full_match("SampleName", '[\\w.%-]+') GROUP BY ALL
        UNION ALL SELECT 'unique', 'Well_Index', "Well_Index", count(*) FROM t GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT 'unique', 'WellBarcode', "WellBarcode", count(*) FROM t GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'single', 'Pool_Index_i7', CAST(count(DISTINCT "Pool_Index_i7") AS STRING), count(*) FROM t HAVING count(DISTINCT "Pool_Index_i7") > 1
        UNION ALL SELECT 'mask', 'MaskWells', m, count(*) FROM t WHERE m NOT IN ('0', '1') GROUP BY ALL""",
    "downsample_plan": _with(_W, _R, *_M, *_qc("m"), *_PLAN) + 'SELECT bc_idx, well, qc_pass_reads, lim AS "limit", round(CASE WHEN mask THEN 0.0 WHEN qc_pass_reads <= lim THEN 1.0 ELSE least(1.0, CAST(lim AS DOUBLE) / qc_pass_reads) END, 9) AS fraction FROM plan',
    "downsample_apply": _with(_W, _R, *_M, *_qc("m"), *_PLAN, *_KEPT) + "SELECT read_id, kept FROM kept",
    "gene_assign": _with(_A, _X, _ASSIGN) + "SELECT al.aln_id, CASE WHEN h.g IS NULL THEN 'Unassigned_NoFeatures' ELSE 'Assigned' END AS xs, coalesce(h.g, '') AS genes FROM al LEFT JOIN (SELECT aln_id, string_agg(CAST(gene AS STRING), ',' ORDER BY gene) AS g FROM hit GROUP BY aln_id) h ON al.aln_id = h.aln_id WHERE al.is_mapped",
    "exon_union_length": _with(_X, *_LEN) + "SELECT gene, CAST(length AS BIGINT) AS length FROM len",
    "read_collapse": _with(*_COLL) + "SELECT bc_idx, qname, umi, outcome, coalesce(len(places), 0) AS n_places, array_to_string(genes, ',') AS genes, n_alignments FROM c",
    "umi_dedup_exact": _with(*_COLL) + "SELECT bc_idx, qname, duplicate FROM ex",
    "dedup_counters": _with(*_COLL) + "SELECT * FROM ded",
    "unmapped_counts": _with(_A) + "SELECT bc_idx, count(*) AS count FROM al WHERE NOT qcfail AND NOT is_mapped GROUP BY bc_idx",
    "fragment_length": _with(_A) + "SELECT CAST(floor(avg(seq_length)) AS BIGINT) AS fragment_length FROM al WHERE is_mapped AND is_primary AND NOT qcfail",
    "count_unique": _with(*_SETS) + "SELECT bc_idx, gene, count FROM uq",
    "multigene_sets": _with(*_SETS) + "SELECT bc_idx, array_to_string(genes, ',') AS genes, count FROM st",
    "alloc_uniform": _alloc("r / k"),
    "alloc_propunique": _alloc("CASE WHEN total > 0 THEN r * u / total ELSE r / k END"),
    "alloc_rescue": _alloc("r * (u + r / k) / (total + r)"),
    "matrix_sum": _with(_G) + "SELECT gene, bc_idx, count(*) AS count FROM rg GROUP BY ALL",
    "tpm": _norm(_TPM, "tpm"),
    "length_adjusted_tpm": _norm(_TPM, "tpm", shorter="w.bc_idx * 20"),
    "tpm_without_rrna": _norm(_TPM, "tpm", counted="len.gene % 11 <> 0"),
    "fpkm": _norm("CASE WHEN l > 0 THEN n * 1e9 / nullif(sum(n) FILTER (WHERE counted) OVER (PARTITION BY bc_idx), 0) / l END", "fpkm"),
    "well_report": _with(
        _W, _R, *_M, *_qc("m"), _REASON, *_PLAN, *_KEPT, *_COLL, ("un", "SELECT bc_idx, count(*) AS n FROM al WHERE NOT qcfail AND NOT is_mapped GROUP BY bc_idx"),
        ("z", f"""SELECT reason.bc_idx, reason.well, {' + '.join(REASONS)} AS t, PASS AS p, coalesce(k.n, 0) AS o, coalesce(un.n, 0) AS u, coalesce(ded."PASSED_QC", 0) AS g, coalesce(ded."UMI_COUNTS", 0) AS f, coalesce(ded."TOTAL", 0) AS dt
            FROM reason LEFT JOIN (SELECT bc_idx, count(*) AS n FROM kept WHERE kept GROUP BY bc_idx) k ON reason.bc_idx = k.bc_idx LEFT JOIN un ON reason.bc_idx = un.bc_idx LEFT JOIN ded ON reason.bc_idx = ded.bc_idx"""),
    ) + "SELECT bc_idx, well, t AS TOTAL_IN, " + ", ".join(_PCT.format(a=a, b=b, n=n) for a, b, n in (("t", "p", "QC"), ("p", "o", "DOWNSAMPLING"), ("o", "(o - u)", "UNMAPPED"), ("(o - u)", "g", "UNASSIGNED"), ("g", "f", "UMI")))
    + ", f AS FINAL_UMI, o AS DOWNSAMPLE_OUT, u AS UNMAP_COUNT, dt AS DEDUP_TOTAL FROM z",
    "position_quality": _with(_R) + "SELECT i AS position, count(*) AS reads, round(avg(ascii(substr(cdna_qual, i, 1)) - 33), 6) AS mean_quality FROM (SELECT cdna_qual, CAST(unnest(range(1, length(cdna_qual) + 1)) AS INT) AS i FROM r) x GROUP BY i",
    "umi_similarity": _with(_R, ("u", "SELECT DISTINCT umiseq FROM r")) + "SELECT a.umiseq AS a, b.umiseq AS b, CAST(levenshtein(a.umiseq, b.umiseq) AS INT) AS distance FROM u a JOIN u b ON a.umiseq < b.umiseq WHERE levenshtein(a.umiseq, b.umiseq) <= 2",
}
