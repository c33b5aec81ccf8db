"""Every query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from plexwell.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    if value is None or value != value:
        return ""
    return str(value) if isinstance(value, (bool, str)) else str(float(value))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = sorted(tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect())
    if name not in SQL:
        assert rows
        return
    told = duck.execute(SQL[name])
    columns = [d[0] for d in told.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows == sorted(tuple(plain(v) for _, v in sorted(zip(columns, r, strict=True))) for r in told.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 26
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["tpm", "fpkm", "length_adjusted_tpm", "tpm_without_rrna"])
def test_normalisation_covers_every_gene_of_every_well(spark, duck, name):
    """Against plain Python: no annotated gene is left out."""
    wells = [b for (b,) in duck.execute("SELECT CAST(n_nationkey AS INT) FROM nation").fetchall()]
    spans = {}
    for gene, price in duck.execute("SELECT p_partkey, CAST(floor(p_retailprice) AS BIGINT) FROM part").fetchall():
        for j in range(3):
            spans.setdefault(gene, []).append((gene * 50 + j * 200, gene * 50 + j * 200 + 120 + price % 150))
    lengths = {}
    for gene, of in spans.items():
        blocks = []
        for a, b in sorted(set(of)):
            if blocks and a <= blocks[-1][1] + 1:
                blocks[-1][1] = max(blocks[-1][1], b)
            else:
                blocks.append([a, b])
        lengths[gene] = sum(b - a for a, b in blocks)
    told = duck.execute("SELECT bc, g, count(*) FROM (SELECT DISTINCT o_custkey % 25 AS bc, o_orderkey, l_partkey % 50 AS g FROM lineitem JOIN orders ON l_orderkey = o_orderkey) x GROUP BY ALL").fetchall()
    counts = {(b, g): n for b, g, n in told}
    want = {}
    for w in wells:
        length = {g: max(n - (w * 20 if name == "length_adjusted_tpm" else 0), 0) for g, n in lengths.items()}
        rate = {g: counts.get((w, g), 0) / n for g, n in length.items() if n}
        counted = [g for g in lengths if name != "tpm_without_rrna" or g % 11]
        total = sum(counts.get((w, g), 0) for g in counted) if name == "fpkm" else sum(rate.get(g, 0) for g in counted)
        scale = 1e9 if name == "fpkm" else 1e6
        want |= {(w, g): rate.get(g, 0) * scale / total if total else 0.0 for g in lengths}
    rows = QUERIES[name](spark, SF).collect()
    got = {(r[0], r[1]): r[2] for r in rows}
    assert len(rows) == len(got) and got.keys() == want.keys() and max(g for _, g in got) >= 60
    assert all(abs(got[k] - want[k]) < 1e-3 for k in want)
