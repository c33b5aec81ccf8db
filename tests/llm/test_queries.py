"""Every registered query over whole small tables, against SQL where there is some."""

import glob
import os

import duckdb
import pytest

from plexwell.llm import license_scan, registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def told(folder, sql, columns):
    with duckdb.connect() as c:
        for f in glob.glob(f"{folder}/*.parquet"):
            files = f"{f}/*.parquet" if os.path.isdir(f) else f
            c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{files}'")
        return sorted(map(str, c.execute(f"SELECT {', '.join(columns)} FROM ({sql}) x").fetchall()))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    got = registry.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.select(sorted(got.columns)).collect()]
    if name in registry.SQL:
        assert sorted(map(str, rows)) == told(SF, registry.SQL[name], sorted(got.columns))
    elif name != "op9_packing":  # one row for each document or page
        table = "pages" if name == "op4_style_tree" else "documents"
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_license_runs_in_sql(spark, tmp_path):
    grant, text = license_scan.TEMPLATES["MIT-grant"].split(), license_scan.TEXTS["BSD-3-Clause-text"].split()
    wrap = lambda ws, n, lead="": "\n".join(lead + " ".join(ws[k : k + n]) for k in range(0, len(ws), n))
    rows = [(1, "Title\n" + wrap(grant, 12, " * ")), (2, "Copyright 2020 Foo. Released under the MIT License."), (4, "x This work is licensed\nunder CC BY-NC 4.0. tail"), (5, "a\n" + wrap(text, 11))]
    rows += [(6, "Released under the\nMIT License. Released under the MIT License.\nReleased under the MIT License."), (2, "Released under\nthe MIT License."), (2, "Released under\nthe MIT License."), (None, "Released under the MIT License"), (8, None), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = license_scan.op2_license_scan(spark, str(tmp_path))
    assert sorted(str(tuple(r)) for r in got.select(sorted(got.columns)).collect()) == told(tmp_path, license_scan.SQL_OP2, sorted(got.columns))
    assert got.count() >= 8
