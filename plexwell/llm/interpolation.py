"""Language-model scoring by deleted interpolation.

The model mixes maximum-likelihood estimates of orders ``order`` to 1 and a uniform one over the distinct training tokens and
one unknown. Mixture weights depend on the bucket of the context's frequency. They are learned on training documents that are
deleted from the counts: expectation-maximisation runs over the deleted tokens' estimates, gathered as a histogram whose
cells (bucket and the estimates on a fine logarithmic grid) are bounded in number whatever the corpus. The final counts
are those of all training documents.

Every n-gram of every document is counted, without sending it more than once for each block of documents:

1. documents are coded in blocks (a vocabulary of 64-bit word hashes, and each token's place in it), written as a table;
2. for one order after another, each block sends its distinct n-grams, as packed sorted hashes with their counts, to the bucket of their hash; a bucket
   adds up and answers each block with packed totals. A frequent word or passage is one entry for each block, so no bucket
   is hot, and buckets grow in number with the corpus;
3. a block meets the answers to it and scores its documents. Deleted documents have blocks of their own, which alone
   take part in learning the weights.

64-bit hashes of n-grams stand for them (two of n differ in hash but for about n^2 / 2^65).

Null and empty texts are one end token. Rows with equal or null doc_id are handled each for themselves. Without training
documents every token has the uniform probability. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, Scratch, crc_of, cut_batches, giving_back, share, text_bytes

ORDER = 3
#: Of the training documents, one in so many is deleted from the counts while weights are learned.
DELETED = 10
#: Text bytes of a block, and entries of a bucket.
BLOCK_BYTES, BUCKET_ENTRIES = 8 << 20, 750_000
#: Context frequencies 1, 2-3, 4-7 ... share weights; bucket 0 has unseen contexts.
CONTEXT_BUCKETS = 24
#: Steps of the grid for each doubling, and of expectation-maximisation; a grid place takes PLACE_BITS.
GRID, EM_STEPS, PLACE_BITS = 6, 60, 10
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
TRAIN, DEV, HELD_OUT = 0, 1, 2


def part_of(doc_id: int | None) -> int:
    crc = crc_of(doc_id)
    return HELD_OUT if crc % 7 == 2 else DEV if crc // 7 % DELETED == 0 else TRAIN


def _mix(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """The hash of an n-gram from that of its first words and the next word's (each step a bijection of the sum)."""
    x = h * np.uint64(0x9FB21C651E98DF25) + nxt
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


_BLOCK = "block long, dev boolean, docs array<long>, parts binary, ends binary, vocab binary, n long, tokens binary"


def _blocks(batches):
    """Documents coded in blocks; deleted documents and others are in different ones."""
    task = TaskContext.get().partitionId()
    open_: dict[bool, dict] = {}
    made = 0

    def fresh():
        return {"docs": [], "parts": bytearray(), "ends": [], "vocab": {}, "tokens": [], "bytes": 0, "n": 0}

    def close(dev: bool):
        nonlocal made
        x = open_.pop(dev)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in x["vocab"]), np.uint64, len(x["vocab"]))
        # words in the order of their hashes: blocks ask alike, and differences of hashes are short
        used, place = np.unique(np.concatenate(([END], hashes)), return_inverse=True)
        tokens = place.astype("<i4")[np.concatenate(x["tokens"])]
        row = {
            "block": task << 25 | made << 1 | dev, "dev": dev, "docs": x["docs"], "parts": bytes(x["parts"]), "ends": np.array(x["ends"], "<i8").tobytes(),
            "vocab": _deltas(used), "n": x["n"], "tokens": zstandard.compress(tokens.tobytes(), 6),
        }
        made += 1
        kinds = (pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    for batch in cut_batches(batches, 1):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = part_of(doc)
            x = open_.setdefault(part == DEV, fresh())
            words, vocab = text.translate(LOWER).split(), x["vocab"]
            # token 0 is the end; a word's place follows from the order in which words come
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in words]
            ids.append(0)
            x["tokens"].append(np.array(ids, np.int32))
            x["n"] += len(ids)
            x["docs"].append(doc)
            x["parts"].append(part)
            x["ends"].append(x["n"])
            x["bytes"] += len(text) + 64
            if x["bytes"] >= BLOCK_BYTES:
                yield close(part == DEV)
    for dev in list(open_):
        yield close(dev)


class Block:
    """A coded block: for each order the distinct n-grams (sorted hashes) and each token's place among them."""

    def __init__(self, row: dict, kinds: range):
        self.docs = row["docs"]
        self.parts = np.frombuffer(row["parts"], np.uint8)
        self.ends = np.frombuffer(row["ends"], "<i8")
        vocab = _hashes(row["vocab"])
        tokens = np.frombuffer(zstandard.decompress(row["tokens"]), "<i4")
        self.starts = np.concatenate(([0], self.ends[:-1]))
        self.doc = np.repeat(np.arange(len(self.ends), dtype=np.int32), np.diff(np.concatenate(([0], self.ends))))
        self.grams = {0: (vocab, tokens)} if 0 in kinds else {}
        # before a document stand start symbols
        hashes, n = vocab[tokens], len(tokens)
        first = np.arange(n) - self.starts[self.doc]
        for k in kinds:
            if k:
                ctx = np.full(n, START)
                for back in range(k, 0, -1):
                    prev = np.where(first >= back, hashes[np.maximum(np.arange(n) - back, 0)], START)
                    ctx = prev if back == k else _mix(ctx, prev)
                g, at = np.unique(_mix(ctx, hashes), return_inverse=True)
                self.grams[k] = (g, at.astype(np.int32))

    def kinds(self):
        """(kind, hashes, places of tokens): kind k for n-grams of order k + 1."""
        for kind, (hashes, at) in self.grams.items():
            yield kind, hashes, at

    def contexts(self, shorter: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each token's context occurs, from the totals of the n-grams one shorter: the one that ends a token before.

        A document's first context is as frequent as documents are, and so as end tokens (``ends``: totals of words).
        """
        out = np.empty_like(shorter)
        out[1:] = shorter[:-1]
        out[self.starts] = ends[self.ends - 1]
        return out

    def by_bucket(self, hashes: np.ndarray, buckets: int):
        """Slices of sorted hashes that go to each bucket (ranges of the hash)."""
        cuts = np.append(np.searchsorted(hashes, _limits(buckets)), len(hashes))
        for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if j > i:
                yield b, i, j


def _limits(buckets: int) -> np.ndarray:
    """The least hash of each bucket."""
    return np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)


_ASK = "kind int, bucket int, block long, hashes binary, counts binary"


def _deltas(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, in as many bytes as the largest needs; the first byte tells."""
    d = np.diff(hashes, prepend=np.uint64(0))
    first, rest = d[:1].tobytes(), d[1:]
    width = max(1, (int(rest.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + first + rest.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _hashes(raw: bytes) -> np.ndarray:
    width = raw[0]
    rest = np.frombuffer(raw, np.uint8, offset=9).reshape(-1, width)
    d = np.zeros((len(rest) + 1, 8), np.uint8)
    d[0] = np.frombuffer(raw, np.uint8, 8, 1)
    d[1:, :width] = rest
    return np.cumsum(d.view("<u8").ravel(), dtype=np.uint64)


def _packed(counts: np.ndarray) -> bytes:
    """Counts as one byte each where they fit, else eight; the first byte tells."""
    return b"\1" + counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b"\x08" + counts.astype("<i8").tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if raw[0] == 1 else "<i8", offset=1).astype(np.int64)


def _ask(buckets: int, kind: int):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                block_id, block = batch.column(0)[at].as_py(), Block(batch.slice(at, 1).to_pylist()[0], range(kind, kind + 1))
                learnt = block.parts[block.doc] != HELD_OUT  # of a block with deleted documents, all are
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                for _, hashes, place in block.kinds():
                    counts = np.bincount(place[learnt], minlength=len(hashes))
                    out: list[list] = [[] for _ in kinds]
                    for b, i, j in block.by_bucket(hashes, buckets):
                        for c, v in zip(out, (kind, b, block_id, _deltas(hashes[i:j]), _packed(counts[i:j])), strict=True):
                            c.append(v)
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[f.split()[0] for f in _ASK.split(", ")])

    return run


_ANSWER = "block long, kind int, bucket int, kept binary, full binary, kept_tokens long, full_tokens long, full_types long, kept_types long"


def _answer(group: pa.Table) -> pa.Table:
    """All that was asked of one bucket: totals in the kept and in all training documents, for each block in its order."""
    hashes = [_hashes(h) for h in group.column("hashes").to_pylist()]
    found, at = np.unique(np.concatenate(hashes), return_inverse=True)
    counts = [_unpacked(x) for x in group.column("counts").to_pylist()]
    zero = [np.zeros(len(x), np.int64) if b & 1 else x for b, x in zip(group.column("block").to_pylist(), counts, strict=True)]
    # sums of doubles are exact below 2^53
    kept = np.bincount(at, np.concatenate(zero), len(found)).astype(np.int64)
    full = np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)
    del counts, zero
    ends = list(accumulate(map(len, hashes)))
    n = len(hashes)
    spans = [at[e - len(h) : e] for e, h in zip(ends, hashes, strict=True)]
    once = [0] * (n - 1)  # facts of the bucket stand in its first row
    return pa.table(
        {
            "block": group.column("block"), "kind": group.column("kind"), "bucket": group.column("bucket"),
            "kept": pa.array([_packed(kept[s]) if b & 1 else None for b, s in zip(group.column("block").to_pylist(), spans, strict=True)], pa.binary()), "full": pa.array([_packed(full[s]) for s in spans], pa.binary()),
            "kept_tokens": pa.array([int(kept.sum()), *once], pa.int64()), "full_tokens": pa.array([int(full.sum()), *once], pa.int64()),
            "full_types": pa.array([int((full > 0).sum()), *once], pa.int64()), "kept_types": pa.array([int((kept > 0).sum()), *once], pa.int64()),
        }
    )


def _context_bucket(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the whole part of the binary logarithm of its frequency."""
    return np.minimum(np.frexp(c.astype(np.float64))[1], CONTEXT_BUCKETS - 1)


def _counts(row: dict, answers: list[dict], order: int, field: str, buckets: int):
    """The block, and for each kind the totals of each token's n-gram or context."""
    block = Block(row, range(order))
    by = {(a["kind"], a["bucket"]): a[field] for a in answers}
    out = {}
    for kind, hashes, at in block.kinds():
        total = np.zeros(len(hashes), np.int64)
        for b, i, j in block.by_bucket(hashes, buckets):
            total[i:j] = _unpacked(by[kind, b])
        out[kind] = total[at]
    for k in range(1, order):
        out[100 + k] = block.contexts(out[k - 1], out[0])
    return block, out


def _estimates(counts: dict[int, np.ndarray], order: int, tokens: int, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of each order for each token (columns: uniform, 1, 2 ...), and the bucket of the longest context."""
    one = counts[0]
    cols = [np.full(len(one), 1.0 / (types + 1)), one / max(tokens, 1)]
    for k in range(1, order):
        cols.append(counts[k] / np.maximum(counts[100 + k], 1))
    bucket = _context_bucket(counts[100 + order - 1]) if order > 1 else np.zeros(len(one), np.int64)
    return np.stack(cols, axis=1), bucket


def _cells(p: np.ndarray) -> np.ndarray:
    """The grid cell of each estimate; 0 is for probability zero."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.round(-np.log2(p) * GRID), 0).astype(np.int64)


def learn(cells: list[tuple[int, list[int], float]], order: int, uniform: float) -> np.ndarray:
    """Weights (bucket, order) by expectation-maximisation over weighted cells: (bucket, grid places of orders 1.., tokens).

    A bucket without deleted tokens takes the weights of all together.
    """
    bucket, n = (np.array([c[k] for c in cells]) for k in (0, 2))
    return _learn(bucket, np.array([c[1] for c in cells], np.float64).reshape(len(cells), order), n.astype(np.float64), uniform)


def _learn(bucket: np.ndarray, place: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    order = place.shape[1]
    weights = np.full((CONTEXT_BUCKETS, order + 1), 1.0 / (order + 1))
    if not len(n):
        return weights
    p = np.concatenate((np.full((len(n), 1), uniform), np.where(place > 0, 2.0 ** (-(place - 1) / GRID), 0.0)), axis=1)

    def run(p, n, w):
        for _ in range(EM_STEPS):
            share = p * w
            share *= (n / share.sum(axis=1))[:, None]
            w = share.sum(axis=0) / n.sum()
        return w

    everything = run(p, n, weights[0])
    for b in range(CONTEXT_BUCKETS):
        own = bucket == b
        weights[b] = run(p[own], n[own], everything) if own.any() else everything
    return np.maximum(weights, 1e-9) / np.maximum(weights, 1e-9).sum(axis=1, keepdims=True)


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "interpolation")
    blocks = scratch.table(text_bytes(docs, "doc_id").mapInArrow(giving_back(_blocks), _BLOCK), "blocks")
    size = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    buckets = max(1, -(-size // BUCKET_ENTRIES))
    answers = None
    for kind in range(order):  # one order after another, as the shuffle files of one are deleted before the next
        asked = blocks.mapInArrow(giving_back(_ask(buckets, kind)), _ASK)
        told = scratch.table(asked.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWER), f"answers-{kind}")
        answers = told if answers is None else answers.unionByName(told)
    sums = answers.where("kind = 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("kept_tokens", "full_tokens", "full_types", "kept_types"))).first()
    total = share(spark, tuple(sums))

    def together(rows: DataFrame, listed: DataFrame, f, schema: str) -> DataFrame:
        """``f`` on each block and what was answered to it."""
        return rows.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(f, schema)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        _, counts = _counts(left.to_pylist()[0], right.to_pylist(), order, "kept", buckets)
        p, bucket = _estimates(counts, order, total.value[0], total.value[3])
        cell = bucket.astype(np.int64)
        for places in _cells(p[:, 1:]).T:
            cell = cell << PLACE_BITS | np.minimum(places, (1 << PLACE_BITS) - 1)
        cells, n = np.unique(cell, return_counts=True)
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

    histogram = together(blocks.where("dev"), answers.where("block % 2 = 1").select("block", "kind", "bucket", "kept"), gather, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    seen = histogram.orderBy("cell").toArrow()  # cells of the grid at most, 16 bytes each
    cell, n = (seen.column(k).to_numpy() for k in (0, 1))
    places = np.stack([cell >> PLACE_BITS * k & (1 << PLACE_BITS) - 1 for k in reversed(range(order))], axis=1).astype(np.float64)
    weights = share(spark, _learn(cell >> PLACE_BITS * order, places, n.astype(np.float64), 1.0 / (sums["kept_types"] + 1)))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in _SCORES.split(", ")]
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        if not left.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        block, counts = _counts(left.to_pylist()[0], right.to_pylist(), order, "full", buckets)
        _, tokens, types, _ = total.value
        p, bucket = _estimates(counts, order, tokens, types)
        logs = np.log10((p * weights.value[bucket]).sum(axis=1))
        base = np.log10((counts[0] + 1) / (tokens + (types + 1)))
        n = len(block.docs)
        cols = (
            block.docs, block.parts == HELD_OUT, np.diff(np.concatenate(([0], block.ends))), np.bincount(block.doc, counts[0] > 0, n).astype(np.int64),
            np.full(n, tokens), np.bincount(block.doc, base, n), np.bincount(block.doc, logs, n),
        )
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return together(blocks.drop("dev"), answers.select("block", "kind", "bucket", "full"), finish, _SCORES)


def op8_interpolation(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
