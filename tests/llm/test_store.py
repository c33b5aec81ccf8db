"""Token stores that are not whole, wide ids, and checksums against ids put together again."""

import gc
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plexwell.llm import packing, token_store, tokens

from .test_operators import frame, prose

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_damaged_stores_are_told(spark):
    docs = frame(spark, [(k, prose(k, 300)) for k in range(6)])
    store = token_store.write_store(spark, docs, BYTES)
    assert store.narrow and token_store.read_back(store).count() == 6
    one = store.chunks.first()["digest"]
    lost = token_store.TokenStore(store.chunks.where(F.col("digest") != F.lit(bytes(one))), store.recipes, store.manifest, True)
    wrong = token_store.TokenStore(store.chunks, store.recipes, store.manifest.withColumn("root", F.lit(b"x")), True)
    short = token_store.TokenStore(store.chunks, store.recipes.where("doc_id <> 3"), store.manifest, True)
    other = token_store.TokenStore(store.chunks.withColumn("payload", F.concat("payload", F.lit(b"\0\0"))), store.recipes, store.manifest, True)
    for bad in (lost, wrong, short, other):
        with pytest.raises(Exception, match="not in the store|manifest|address"):
            token_store.read_back(bad).collect()
    with pytest.raises(Exception, match="not in the store"):
        token_store.read_ids(lost).collect()


def test_wide_ids(spark):
    docs = frame(spark, [(1, "one"), (2, None)])
    store = token_store.write_store(spark, docs, BYTES, end_id=70000)
    assert not store.narrow
    assert {r["doc_id"]: r["ids"][-1] for r in token_store.read_ids(store).collect()} == {1: 70000, 2: 70000}
    with pytest.raises(Exception, match="16 bits"):
        token_store.write_store(spark, docs, BYTES, end_id=70000, max_id=1 << 16)


def test_store_of_all_small_documents(spark):
    """The registered query's checksums are those of the ids put together again."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    store = token_store.write_store(spark, docs, BYTES)
    crc = F.crc32(F.unhex(F.array_join(F.transform("ids", lambda i: F.concat(*(F.lpad(F.hex(F.shiftright(i, 8 * k).bitwiseAND(255)), 2, "0") for k in range(4)))), "")))
    want = {(r[0], r[1], r[2], r[3]) for r in token_store.read_ids(store).select("doc_id", "start", F.size("ids"), crc).collect()}
    assert {tuple(r) for r in token_store.read_back(store).collect()} == want


def test_encoder_of_batches(monkeypatch):
    """Batches equal the library text by text, also when the tables of units are full again and again."""
    rng = np.random.default_rng(7)
    syllables = ["the", "qu", "öß", "x1", "n't", ".\n", "İ", "ŉ", "\t", ",", "日", "zz"]
    words = ["".join(rng.choice(syllables, rng.integers(1, 9))) for _ in range(400)] + ["", "é" * 12, "é" * 12 + "a", "b" * 24, "b" * 25, "a\0", "a"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 30, 300)] + [" ".join(words), " ".join(words[400:][::-1]), None, "", "<|endoftext|>", "b" * 24]
    texts += [w + " " + v for w, v in zip(words, words[1:])]
    for slots, pieces in ((1 << 20, 30_000), (32, 8)):
        monkeypatch.setattr(tokens, "SLOTS", slots)
        monkeypatch.setattr(tokens, "PIECES", pieces)
        monkeypatch.setattr(tokens, "SOME", slots)
        for name in (BYTES, public_tokenizers.path("word_bpe_49k.json")):
            e = tokens.Encoder(name)
            want = [e.whole(t or "") for t in texts]
            for _ in range(2):
                ids, counts = e.encode_all(pa.array(["cut off", *texts]).slice(1))
                assert ids.tobytes() == b"".join(want) and counts.tolist() == [len(w) // 4 for w in want]
            assert e.units.young.used <= 0.7 * slots and e.units.old.used <= 0.7 * slots


def test_plain_units_are_cut_in_arrays():
    """Units of letters, digits, marks and single line ends need no regex each; all others still get one, and ids are the library's."""
    rng = np.random.default_rng(11)
    signs = [*map(chr, range(33, 0x250)), "\n", "\n", ".", ",", *"abcdefghij", "0", "9", "\t", "\r", "\u3000", "日", "👍", "ſ", "\0"]
    units = ["".join(rng.choice(signs, rng.integers(1, 12))) for _ in range(30_000)] + ["", "a\n", "\na", "a\n\nb", "×", "a÷b", "Öß.\nÄ", "x\n\u3000", "it's", "b" * 40]
    e = tokens.Encoder(BYTES)
    runs, per, plain = tokens._runs(pa.array(units).slice(3))
    want = [e.find(" " + u) for u, ok in zip(units[3:], plain, strict=True) if ok]
    assert runs.to_pylist() == [p.removeprefix(" ") for w in want for p in w] and per.tolist() == list(map(len, want)) and plain.sum() > 2000
    texts = ["x " + u + " y" for u in units] + ["x " + u for u in units]
    ids, counts = e.encode_all(pa.array(texts))
    told = [e.whole(t) for t in texts]
    assert ids.tobytes() == b"".join(told) and counts.tolist() == [len(t) // 4 for t in told]
    asked = []
    fresh = tokens.Encoder(BYTES)
    fresh.cut = lambda unit, prefix: (asked.append(unit), tokens.Encoder.cut(fresh, unit, prefix))[1]
    fresh.encode("It was, übung.\nNext 12%%% a1b2, (end) it's")
    assert asked == ["it's"]


def test_checksums_of_many_chunks_are_put_together_in_arrays(monkeypatch):
    """No product of polynomials in Python for each chunk, and the checksum is that of all ids."""
    rng = np.random.default_rng(5)
    docs = [[rng.integers(0, 50_000, n).astype("<u4") for n in rng.integers(1, 1025, k)] for k in (1, 2, 3000, 7)]
    calls, times = [], token_store._times
    monkeypatch.setattr(token_store, "_times", lambda a, b: (calls.append(1), times(a, b))[1])
    found, sizes, roots = [], [], []
    for k, doc in enumerate(docs):
        keys = [token_store.digest(c.tobytes()) for c in doc]
        parts = [{"pos": p, "n": len(c), "crc": zlib.crc32(c), "digest": x} for p, (c, x) in enumerate(zip(doc, keys, strict=True))]
        found.append([parts[p] for p in rng.permutation(len(parts))])
        sizes.append(sum(map(len, doc)))
        roots.append(token_store.merkle(keys))
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int32()), ("crc", pa.int64()), ("digest", pa.binary())]))
    ids = pa.array(range(4), pa.int64())
    batch = pa.record_batch([ids, ids, pa.array(sizes, pa.int64()), pa.array(roots), pa.array(found, kind)], names=["doc_id", "start", "n_tokens", "root", "found"])
    (out,) = token_store._verify([batch])
    assert out.column(3).to_pylist() == [zlib.crc32(b"".join(c.tobytes() for c in doc)) for doc in docs]
    assert out.slice(1).num_rows == 3 and [b.column(3)[0].as_py() for b in token_store._verify([batch.slice(2, 1)])] == [out.column(3)[2].as_py()]
    calls.clear()
    list(token_store._verify([batch, batch]))
    assert len(calls) < 2600  # 1023 and one for each 1024 ids of the longest document, not one or more for each of 6,026 chunks


def test_kept_units_take_little_memory():
    """A worker of the pipeline keeps them beside what other stages left: arrays, not two objects and a place in a dict for each."""
    e = tokens.Encoder(BYTES)
    text = " ".join(f"u{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}w{k}" for k in range(150_000))
    tracemalloc.start()
    e.encode(text)
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 135 * 150_000


def test_packing_takes_short_batches(spark, monkeypatch):
    """Few rows at a time while pieces are cut; the session's own setting holds again after."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, path = spark.conf.get(key), public_tokenizers.path("word_bpe_49k.json")
    seen = []
    table = packing.Scratch.table
    monkeypatch.setattr(packing.Scratch, "table", lambda self, df, name: (seen.append((name, int(spark.conf.get(key)))), table(self, df, name))[1])
    docs = frame(spark, [(k, "a few words") for k in range(3000)])
    assert packing.pack(spark, docs, path).count() == 3000
    assert dict(seen)["pieces"] <= 1000 and spark.conf.get(key) == before
