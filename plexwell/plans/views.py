"""Deterministic reads, wells, genes and alignments made from the star-schema tables, in SQL that two engines share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ADAPTER = "AGATCGGAAGAGCACA"
HEX = "0123456789abcdef"
SPAN = 100_000


def acgt(x: str) -> str:
    """32 bases that depend on a text."""
    return f"translate(md5({x}), '{HEX}', 'ACGTACGTACGTACGT')"


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _changed(s: str, p: str, to: str = "translate(substr({s}, {p}, 1), 'ACGT', 'CGTA')") -> str:
    return f"(substr({s}, 1, {p} - 1) || {to.format(s=s, p=p)} || substr({s}, {p} + 1))"


WHITELIST = f"""
SELECT CAST(n_nationkey AS INT) AS bc_idx, substr({acgt("'bc' || " + text("n_nationkey"))}, 1, 16) AS seq, n_name AS well,
       CAST(n_nationkey % 5 + 1 AS INT) AS x, CAST(floor(n_nationkey / 5) + 1 AS INT) AS y, n_nationkey % 12 = 0 AS mask
FROM {{nation}}"""

_E = text("event_id")
READS = f"""
SELECT event_id AS read_id, 'r:' || {_E} AS name, CAST(event_id % 2 AS INT) AS lane, bcseq, cdna_seq,
       CASE WHEN event_id % 7 = 0 AND length(cdna_seq) >= 25 THEN substr(q, 1, length(cdna_seq) - 25) || repeat('*', 25) ELSE substr(q, 1, length(cdna_seq)) END AS cdna_qual,
       CASE WHEN event_id % 6 = 5 THEN {_changed("umi", "(CAST(event_id % 10 AS INT) + 1)")} ELSE umi END AS umiseq, umiqual
FROM (
  SELECT event_id, umi, umiqual, q,
         CASE WHEN k < 7 THEN s WHEN k = 7 THEN {_changed("s", "p")} WHEN k = 8 THEN {_changed(_changed("s", "p"), "p2")}
              WHEN event_id % 20 = 9 THEN {_changed("s", "p", "'N'")} ELSE {_changed(_changed("s", "p", "'N'"), "p2", "'N'")} END AS bcseq,
         CASE WHEN event_id % 13 = 0 THEN substr(substr(c, 1, h) || 'AAAAAAAAAAAA' || substr(c, h + 13), 1, 90)
              WHEN event_id % 17 = 0 THEN substr(substr(c, 1, a) || '{ADAPTER}' || substr(c, a + 17), 1, 90)
              WHEN event_id % 19 = 0 THEN translate(c, 'GC', 'AT') WHEN event_id % 29 = 0 THEN translate(c, 'AT', 'GC')
              WHEN event_id % 23 = 0 THEN substr(c, 1, 15) ELSE c END AS cdna_seq
  FROM (
    SELECT e.event_id, w.seq AS s, CAST(e.event_id % 10 AS INT) AS k, CAST(e.event_id % 16 AS INT) + 1 AS p, CAST((e.event_id + 7) % 16 AS INT) + 1 AS p2,
           10 + CAST(e.event_id % 60 AS INT) AS h, 12 + CAST(e.event_id % 75 AS INT) AS a,
           substr({acgt("'a' || " + _E)} || {acgt("'b' || " + _E)} || {acgt("'c' || " + _E)}, 1, 90) AS c,
           translate(md5('q1' || {_E}) || md5('q2' || {_E}) || md5('q3' || {_E}), '{HEX}', '*+5:?BDFFFFFFFFF') AS q,
           substr({acgt("'u' || " + text("user_id % 40"))}, 1, 10) AS umi,
           CASE WHEN e.event_id % 11 = 0 THEN translate(substr(md5('q' || {_E}), 1, 10), '{HEX}', '************FFFF')
                ELSE translate(substr(md5('q' || {_E}), 1, 10), '{HEX}', '*+5:?BDFFFFFFFFF') END AS umiqual
    FROM {{events}} e JOIN ({WHITELIST}) w ON w.bc_idx = e.user_id % 25
  ) b
) x"""

EXONS = f"""
SELECT p_partkey AS gene, 'chr' || {text("p_size % 5")} AS chrom, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
       p_partkey * 50 + t.j * 200 AS start, p_partkey * 50 + t.j * 200 + 120 + CAST(floor(p_retailprice) AS BIGINT) % 150 AS {{end}},
       CASE WHEN p_partkey % 11 = 0 THEN 'Mt_rRNA' ELSE 'protein_coding' END AS biotype
FROM {{part}} CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1 AS j UNION ALL SELECT 2 AS j) t"""

ALIGNMENTS = f"""
SELECT event_id * 3 + t.j AS aln_id, 'r:' || {_E} AS qname, CAST(CASE WHEN event_id % 50 = 0 THEN -1 ELSE user_id % 25 END AS INT) AS bc_idx,
       CASE WHEN event_id % 6 = 5 THEN {_changed(f"substr({acgt(chr(39) + 'u' + chr(39) + ' || ' + text('user_id % 40'))}, 1, 10)", "(CAST(event_id % 10 AS INT) + 1)")}
            ELSE substr({acgt("'u' || " + text("user_id % 40"))}, 1, 10) END AS umi,
       CASE WHEN event_id % 31 = 0 THEN 'FAIL_LENGTH' ELSE 'PASS' END AS qc, event_id % 31 = 0 AS qcfail, t.j = 0 AS is_primary, event_id % 37 <> 0 AS is_mapped,
       'chr' || {text("(user_id + t.j) % 5")} AS chrom, CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END AS strand,
       (user_id * 97 + (event_id % 4) * 13 + t.j * 1111) % {SPAN} AS start, (user_id * 97 + (event_id % 4) * 13 + t.j * 1111) % {SPAN} + 89 AS {{end}}, 255 AS mapq, 90 AS seq_length
FROM {{events}} JOIN (SELECT 0 AS j UNION ALL SELECT 1 AS j UNION ALL SELECT 2 AS j) t ON t.j <= event_id % 3 AND (t.j = 0 OR event_id % 37 <> 0)"""

#: Reads with their genes in long form: an order is a read, its parts (folded to 50) the genes.
READ_GENES = """
SELECT DISTINCT CAST(o_custkey % 25 AS INT) AS bc_idx, o_orderkey AS read_id, l_partkey % 50 AS gene FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""

LAYOUT = f"SELECT y, x, CASE WHEN bc_idx % 7 = 3 THEN substr({acgt(chr(39) + 'free' + chr(39) + ' || ' + text('bc_idx'))}, 1, 16) ELSE seq END AS seq FROM ({WHITELIST}) w"

TEXTS = {"whitelist": WHITELIST, "reads": READS, "exons": EXONS, "alignments": ALIGNMENTS, "read_genes": READ_GENES, "layout": LAYOUT}


class _Names(dict):
    def __missing__(self, key: str) -> str:
        return '"end"' if key == "end" else key


def sql(name: str) -> str:
    """The text of a view over tables of their own names."""
    return TEXTS[name].format_map(_Names())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the Parquet tables of a folder; only the columns it names are read."""
    told = TEXTS[name].replace("{end}", "`end`")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "events", "part", "lineitem", "orders") if f"{{{t}}}" in told}
    return spark.sql(told, **tables)
