"""The pipeline on small tables against its operators' brute-force versions."""

import os

import pytest

import corpus_pipeline
from plexwell.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
def test_stages(spark, tmp_path):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in seen["quality classifier"].collect()}
    assert sum(i in kept for i, q in labels.items() if q) >= 0.97 * sum(labels.values())
    lines = {r["doc_id"]: r["text"] for r in seen["line dedup"].collect()}
    # components of texts whose sets of five-word shingles are 0.8 alike or more
    sets = {i: set(simhash.shingle_hashes((t or "").encode(), 5).tolist()) for i, t in lines.items()}
    left = {r["doc_id"]: r["text"] for r in seen["simhash near-dedup"].collect()}
    group = {i: i for i in sets}
    for i in sorted(sets):
        for j in sets:
            if group[i] != group[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((group[i], group[j]))
                group = {k: a if g == b else g for k, g in group.items()}
    assert set(left) == set(group.values()) and all(left[i] == lines[i] for i in left)
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r["doc_id"]: r["text"] for r in seen["benchmark decontamination"].collect()}
    for i, n, hit, *_ in decontaminate.brute_force(list(left.items()), bench):
        assert (i in clean) == (hit <= 0.5 * n) and (hit > 0 or clean[i] == left[i])
    assert {r["doc_id"] for r in seen["best-fit packing"].collect()} == set(clean)


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
