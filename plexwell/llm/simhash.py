"""SimHash near-duplicates with a Gray-order hierarchical index.

Rows are dealt to groups so that any two that may be linked meet in one. In a group fingerprints stand by Gray rank, where
neighbours share many bits; a leaf takes a few neighbours and an inner node a few nodes, each with the bits all its
fingerprints share. Two nodes whose shared bits already differ in too many places are dropped with everything below them;
two that are one component already need no comparison. A group gives a spanning forest of its links, never its pairs.
Components come from large-star and small-star steps over these forests.

``near_duplicates`` links fingerprints within ``max_diff`` bits, all of them: 64 bits are cut into blocks, and two such
fingerprints agree on all but ``max_diff`` of them. A group that is too large is dealt again by blocks of the bits that it
does not share, so its rows are copied a bounded number of times, not in proportion to its size.

``similar_documents`` links texts whose sets of word shingles have a Jaccard similarity of ``similarity`` or more. Such
texts differ in too many bits for blocks, so rows are dealt by parts of a minhash sketch; the index drops pairs that differ
in more than ``max_diff`` bits, the sketch those far below the similarity, and the rest is confirmed on whole texts: first
for each text the link to its least neighbour, then, between components still apart, their best link, until none is left.

Null texts are empty; a text without words has fingerprint zero, linked like any other (its empty set of shingles equals
another's). Rows with equal doc_id are handled each for themselves; a component of only null doc_ids has a null id. An empty
table gives no rows. Columns other than the id, the text and those of ``keep`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Scratch, cut_batches, giving_back, shuffle_parts

LEAF, FANOUT = 16, 8
#: Pairs of nodes looked at together.
FRONTIER = 1 << 14
#: A group with more rows is dealt again by more bits, while there are more.
GROUP = 1 << 14
#: Mean size a group should have; more fingerprints take more blocks, and so longer keys.
MEAN_GROUP = 1 << 12
#: Bytes of a sketch, how many of them make a key, and how often a group that is too large is dealt again.
BINS, KEY_BINS, REFINE = 64, 4, 3
#: Bits that two texts of 0.8 differ in: about 9.7, with a deviation of 2.9, and more where shingles repeat in one of them.
WIDE_DIFF = 24
#: Least estimates of three passes over a group; below the last, with its deviation of 0.05, no pair of 0.8 is expected.
STEPS = (0.9, 0.8, 0.65)


def shingle_hashes(text: bytes, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; one of the whole sequence if it is shorter, none without words."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, "<u8")
    told = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(told, seed)], "<u8")
    ends = list(accumulate(map(len, words), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends[: len(words) - width])]
    return np.array([xxhash.xxh64_intdigest(told[a:b], seed) for a, b in zip(starts, ends[width - 1 :], strict=True)], "<u8")


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; 0 without any."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        total += np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * total > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Majority bits over the XXH64 of word shingles, repeats included; 0 without words."""
    return majority(shingle_hashes(text, width, seed))


def _scatter(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def sketch(hashes: np.ndarray) -> bytes:
    """One byte of the least hash in each of BINS ranges; an empty range borrows the next full one's, by its distance."""
    if not len(hashes):
        return bytes(BINS)
    placed = np.sort(_scatter(hashes))
    ranges = (placed >> np.uint64(58)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(ranges)) + 1))
    full, least = ranges[first], placed[first]
    at = np.searchsorted(full, np.arange(BINS)) % len(full)
    away = (full[at] - np.arange(BINS)) % BINS
    return (_scatter(least[at] + away.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(56)).astype(np.uint8).tobytes()


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Places of codes in the reflected Gray sequence (inverse of n ^ n >> 1)."""
    out = codes.astype(np.uint64)
    for k in (1, 2, 4, 8, 16, 32):
        out = out ^ (out >> np.uint64(k))
    return out


def _components(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (each the least place of its component) after links a-b join theirs."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


class GrayIndex:
    """Nodes over codes in Gray order; ``forest`` gives a component label to each code."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes  # by Gray rank
        cuts = np.arange(0, len(codes), LEAF)
        ands, ors, spans = [np.bitwise_and.reduceat(codes, cuts)], [np.bitwise_or.reduceat(codes, cuts)], [LEAF]
        while len(ands[-1]) > 1:
            cuts = np.arange(0, len(ands[-1]), FANOUT)
            ands.append(np.bitwise_and.reduceat(ands[-1], cuts))
            ors.append(np.bitwise_or.reduceat(ors[-1], cuts))
            spans.append(spans[-1] * FANOUT)
        self.mask = [~(x ^ y) for x, y in zip(ands, ors, strict=True)]  # bits that all below share
        self.value = [x & m for x, m in zip(ands, self.mask, strict=True)]
        self.spans = spans

    def forest(self, max_diff: int) -> np.ndarray:
        n = len(self.codes)
        label = np.arange(n)
        stack = [(len(self.mask) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            mask, value, span = self.mask[level], self.value[level], self.spans[level]
            shared = mask[a] & mask[b]
            differ = np.bitwise_count((value[a] ^ value[b]) & shared)
            low, high = self._ends(label, span)
            open_ = (differ <= max_diff) & ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            close = open_ & (differ + np.bitwise_count(~shared) <= max_diff)
            if close.any():  # every pair below is close: one chain through both nodes
                at = np.concatenate([np.arange(i * span, min(n, (i + 1) * span)) for i in np.unique(np.concatenate((a[close], b[close])))])
                head = np.concatenate([np.full(min(n, (i + 1) * span) - i * span, i * span) for i in np.unique(np.concatenate((a[close], b[close])))])
                self_close = np.bitwise_count(~mask) <= max_diff
                ok = self_close[at // span]
                label = _components(label, at[ok], head[ok])
                label = _components(label, a[close] * span, b[close] * span)
                open_ &= ~(close & self_close[a] & self_close[b])
            a, b = a[open_], b[open_]
            if not len(a):
                continue
            k = LEAF if level == 0 else FANOUT
            top = n if level == 0 else len(self.mask[level - 1])
            i = (a[:, None] * k + np.repeat(np.arange(k), k)).ravel()
            j = (b[:, None] * k + np.tile(np.arange(k), k)).ravel()
            keep = (i < j if level == 0 else i <= j) & (i < top) & (j < top)
            i, j = i[keep], j[keep]
            if level == 0:
                near = np.bitwise_count(self.codes[i] ^ self.codes[j]) <= max_diff
                label = _components(label, i[near], j[near])
                continue
            order = np.argsort(i - j, kind="stable")  # far ones below, near ones on top: components close early
            for s in range(0, len(order), FRONTIER):
                part = order[s : s + FRONTIER]
                stack.append((level - 1, i[part], j[part]))
        return label

    def near(self, max_diff: int, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places i < j of codes within ``max_diff``, without nodes that ``label`` (which may change) has as one component."""
        n = len(self.codes)
        stack = [(len(self.mask) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, a, b = stack.pop()
            mask, value = self.mask[level], self.value[level]
            low, high = self._ends(label, self.spans[level])
            differ = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b])
            open_ = (differ <= max_diff) & ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            a, b = a[open_], b[open_]
            if not len(a):
                continue
            k = LEAF if level == 0 else FANOUT
            top = n if level == 0 else len(self.mask[level - 1])
            i = (a[:, None] * k + np.repeat(np.arange(k), k)).ravel()
            j = (b[:, None] * k + np.tile(np.arange(k), k)).ravel()
            keep = (i < j if level == 0 else i <= j) & (i < top) & (j < top)
            i, j = i[keep], j[keep]
            if level == 0:
                close = (np.bitwise_count(self.codes[i] ^ self.codes[j]) <= max_diff) & (label[i] != label[j])
                if close.any():
                    yield i[close], j[close]
                continue
            order = np.argsort(i - j, kind="stable")
            for s in range(0, len(order), FRONTIER):
                part = order[s : s + FRONTIER]
                stack.append((level - 1, i[part], j[part]))

    @staticmethod
    def _ends(label: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.arange(0, len(label), span)
        return np.minimum.reduceat(label, cuts), np.maximum.reduceat(label, cuts)


def group_forest(codes: np.ndarray, starts: np.ndarray, max_diff: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, least code of its component) of each group; ``starts``: where groups begin, codes by Gray rank."""
    sizes = np.diff(np.append(starts, len(codes)))
    label = np.arange(len(codes))
    small = np.repeat(sizes <= LEAF, sizes)
    group = np.repeat(np.arange(len(starts)), sizes)
    for d in range(1, min(LEAF, int(sizes.max(initial=1)))):  # groups of one leaf, all at once
        i = np.flatnonzero(small[:-d] & (group[:-d] == group[d:]))
        if len(i):
            near = np.bitwise_count(codes[i] ^ codes[i + d]) <= max_diff
            label = _components(label, i[near], i[near] + d)
    for s, n in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
        label[s : s + n] = GrayIndex(codes[s : s + n]).forest(max_diff) + s
    at = np.flatnonzero(label != np.arange(len(label)))
    return codes[at], codes[label[at]]


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray, w: np.ndarray) -> list[int]:
    """Join components by links i-j, the best first; the links that did (as places in the arrays)."""
    used = []
    for k in np.lexsort((j, i, -w)).tolist():
        x, y = int(label[i[k]]), int(label[j[k]])
        if x != y:
            label[label == max(x, y)] = min(x, y)
            used.append(k)
    return used


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity by sketches (rows of bytes), whose bytes also agree by chance once in 256."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def group_links(codes: np.ndarray, sketches: np.ndarray, starts: np.ndarray, max_diff: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places i, j and estimates of a spanning forest of each group's likely links; codes by Gray rank."""
    sizes = np.diff(np.append(starts, len(codes)))
    out: list[tuple] = []
    label = np.arange(len(codes))
    small = np.repeat((sizes <= LEAF) & (sizes > 1), sizes)
    group = np.repeat(np.arange(len(starts)), sizes)
    found = []
    for d in range(1, min(LEAF, int(sizes.max(initial=1)))):  # groups of one leaf, all at once
        i = np.flatnonzero(small[:-d] & (group[:-d] == group[d:]))
        i = i[np.bitwise_count(codes[i] ^ codes[i + d]) <= max_diff]
        w = estimate(sketches[i], sketches[i + d])
        found.append((i[w >= STEPS[-1]], i[w >= STEPS[-1]] + d, w[w >= STEPS[-1]]))
    if found:
        i, j, w = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((j, i, -w))
        up = list(range(len(codes)))

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for a, b, v in zip(i[order].tolist(), j[order].tolist(), w[order].tolist(), strict=True):
            x, y = top(a), top(b)
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((a, b, v))
    for s, n in zip(starts[sizes > LEAF].tolist(), sizes[sizes > LEAF].tolist(), strict=True):
        index, label, own = GrayIndex(codes[s : s + n]), np.arange(n), sketches[s : s + n]
        for least in STEPS:
            more = False
            for i, j in index.near(max_diff, label):
                w = estimate(own[i], own[j])
                more |= bool((w >= STEPS[-1]).any())
                i, j, w = i[w >= least], j[w >= least], w[w >= least]
                out += [(s + int(i[k]), s + int(j[k]), float(w[k])) for k in _join(label, i, j, w)]
            if not more:  # nothing for a lower limit either
                break
    cols = list(zip(*out, strict=True)) or [(), (), ()]
    return np.array(cols[0], np.int64), np.array(cols[1], np.int64), np.array(cols[2], np.float64)


_EXACT, _LIKELY = "a long, b long", "a long, b long, w double"


def _links(max_diff: int, likely: bool):
    """Rows come by (mask, key) and Gray rank; a group may run over batches."""

    def out(rows: pa.Table) -> pa.RecordBatch:
        codes = rows.column("fp").to_numpy().view(np.uint64)
        keys = np.stack([rows.column(k).to_numpy() for k in ("mask", "key")])
        starts = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1))
        if not likely:
            a, b = group_forest(codes, starts, max_diff)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
        node = rows.column("node").to_numpy()
        sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        i, j, w = group_links(codes, sketches, starts, max_diff)
        return pa.record_batch([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j])), pa.array(w)], names=["a", "b", "w"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            mask, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("mask", "key"))
            other = np.flatnonzero((mask != mask[-1]) | (key != key[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            last = held[-1] if held else None
            if held and (cut or last.column("mask")[-1].as_py() != mask[0] or last.column("key")[-1].as_py() != key[0]):
                yield out(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks())
                held = []
            elif cut:
                yield out(pa.Table.from_batches([batch.slice(0, cut)]))
            held.append(batch.slice(cut))
        if held:
            yield out(pa.Table.from_batches(held).combine_chunks())

    return giving_back(run)


def _cuts(free: list[int], blocks: int, agreeing: int) -> list[int]:
    """Masks of each choice of ``agreeing`` out of ``blocks`` runs of the bits ``free``."""
    edges = [len(free) * k // blocks for k in range(blocks + 1)]
    runs = [sum(1 << b for b in free[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(runs, agreeing)]


def _finer(mask: int, max_diff: int) -> list[int]:
    """Longer masks: codes that agree under ``mask`` and differ in at most ``max_diff`` bits agree under one of them."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | c for c in _cuts(free, max_diff + 2, 2)] if len(free) >= 2 * (max_diff + 2) else [mask]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal_bits(masks: Callable[[int], list[int]]):
    """Each row (mask, key, rank, fp) under every mask that follows from its own."""

    def run(batches):
        for batch in batches:
            had = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            codes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for old in np.unique(had).tolist():
                own = codes[had == old]
                rank = gray_rank(own).view(np.int64) ^ np.int64(-(2**63))  # signed order is that of the rank
                for m in masks(old):
                    cols = np.full(len(own), _signed(m)), (own & np.uint64(m)).view(np.int64), rank, own.view(np.int64)
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], names=["mask", "key", "rank", "fp"])

    return run


def _deal_sketches(turn: int):
    """Each row (mask, key, fp, node, sketch) under the keys of a turn: disjoint parts of the sketch, then further parts."""
    rng = np.random.default_rng(turn)
    parts = [list(range(k, k + KEY_BINS)) for k in range(0, BINS, KEY_BINS)] if turn == 0 else [sorted(rng.choice(BINS, KEY_BINS, replace=False).tolist()) for _ in range(8)]

    def run(batches):
        for batch in batches:
            sketches = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, BINS)
            rank = gray_rank(batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)).view(np.int64) ^ np.int64(-(2**63))
            old = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) ^ batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) << np.uint64(32)
            for k, part in enumerate(parts):
                told = np.ascontiguousarray(sketches[:, part]).view("<u4").ravel().astype(np.uint64)
                key = told if turn == 0 else _scatter(_scatter(old) + told)
                cols = [pa.array(np.full(len(rank), turn * 64 + k, np.int64)), pa.array(key.view(np.int64)), pa.array(rank)]
                yield pa.record_batch([*cols, batch.column(2), batch.column(3), batch.column(4)], names=["mask", "key", "rank", "fp", "node", "sketch"])

    return run


def _grouped(spark: SparkSession, first: DataFrame, again: Callable[[DataFrame, int], DataFrame | None], scratch: Scratch) -> DataFrame:
    """Rows by (mask, key) and Gray rank; a group of more than GROUP rows is dealt ``again``, while that gives any."""
    done, dealt, turn = None, first, 1
    while True:
        large = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("mask", "key")
        large = scratch.table(large, f"large-{turn}")  # no more rows than rows dealt / GROUP
        finer = None if large.isEmpty() else again(dealt.join(large, ["mask", "key"], "left_semi"), turn)
        rest = dealt if finer is None else dealt.join(large, ["mask", "key"], "left_anti")
        done = rest if done is None else done.unionByName(rest)
        if finer is None:
            break
        dealt, turn = finer, turn + 1
    return done.repartition(max(shuffle_parts(spark), 1), "mask", "key").sortWithinPartitions("mask", "key", "rank")


def link_forests(spark: SparkSession, codes: DataFrame, scratch: Scratch, max_diff: int = 3) -> DataFrame:
    """Links (a, b) between distinct ``codes`` (fp) whose components are those of all pairs within ``max_diff``."""
    n = codes.count()
    blocks = max_diff + 1
    while blocks < 8 and n / 2 ** (64 * (blocks - max_diff) // blocks) > MEAN_GROUP:
        blocks += 1
    schema = "mask long, key long, rank long, fp long"
    dealt = codes.select(F.lit(0).cast("long").alias("mask"), "fp").mapInArrow(_deal_bits(lambda _: _cuts(list(range(64)), blocks, blocks - max_diff)), schema)

    def again(rows: DataFrame, turn: int) -> DataFrame | None:
        # a mask that can't be longer comes back as it is: then nothing is gained by another turn
        if turn > 8 or rows.select("mask").distinct().where(F.bit_count("mask") <= 64 - 2 * (max_diff + 2)).isEmpty():
            return None
        return rows.select("mask", "fp").mapInArrow(_deal_bits(lambda m: _finer(m, max_diff)), schema)

    near = _grouped(spark, dealt, again, scratch).select("mask", "key", "fp").mapInArrow(_links(max_diff, False), _EXACT)
    return scratch.table(near.distinct(), "links")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for every node that has a link: large-star and small-star steps until nothing changes."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    before, turn = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("hub")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # now every u is above its v
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("hub"), "m")
        small = large.join(least, F.col("u") == F.col("hub"))
        edges = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        edges = scratch.table(edges, f"edges-{turn}")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if turn > 0:
            scratch.drop(f"edges-{turn - 1}")
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, turn = now, turn + 1


def _print(passed: int, width: int, sketched: bool):
    """The last column, a text as bytes, to its fingerprint, and its sketch where one is wanted."""

    def run(batches):
        for batch in cut_batches(batches, passed):
            hashes = [shingle_hashes(t, width) for t in batch.column(passed).to_pylist()]
            made = [pa.array(np.array([majority(h) for h in hashes], dtype=np.uint64).view(np.int64))]
            if sketched:
                made.append(pa.array([sketch(h) for h in hashes], pa.binary()))
            yield pa.record_batch([*(batch.column(i) for i in range(passed)), *made], names=[*batch.column_names[:passed], "fp", "sketch"][: passed + len(made)])

    return giving_back(run)


def _body() -> Column:
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


def _printed(docs: DataFrame, told: list[Column], width: int, sketched: bool) -> DataFrame:
    told = docs.select(*told, _body().alias("body"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in told.dtypes[:-1])
    return told.mapInArrow(_print(len(told.columns) - 1, width, sketched), f"{kinds}, fp long" + ", sketch binary" * sketched)


def _labelled(printed: DataFrame, codes: DataFrame, stars: DataFrame, by: str) -> DataFrame:
    """``printed`` with component_id, the least of the components' ``least``; ``codes``: ``by`` and least."""
    stars = stars.select(F.col("node").alias("star_node"), F.col("root").alias("star_root"))
    rooted = codes.join(stars, F.col(by) == F.col("star_node"), "left").select(F.col(by).alias("label_code"), "least", F.coalesce("star_root", by).alias("top"))
    ids = rooted.groupBy("top").agg(F.min("least").alias("component_id")).select(F.col("top").alias("root"), "component_id")
    labels = rooted.join(ids, F.col("top") == F.col("root")).select("label_code", "root", "component_id")
    return printed.join(labels, printed[by] == labels["label_code"])


def near_duplicates(docs: DataFrame, keep: Sequence[str] = (), max_diff: int = 3, width: int = 3) -> DataFrame:
    """doc_id, ``keep``, fp (the fingerprint as a signed long), component_id (least doc_id reachable) of every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    printed = scratch.table(_printed(docs, [F.col("doc_id"), *map(F.col, keep)], width, False), "printed")
    codes = scratch.table(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "codes")
    stars = components(link_forests(spark, codes, scratch, max_diff), scratch)
    return _labelled(printed, codes, stars, "fp").select("doc_id", *keep, "fp", "component_id")


def jaccard(a: bytes, b: bytes, width: int) -> float:
    """Similarity of the sets of word shingles; two empty sets are equal."""
    x, y = (set(shingle_hashes(t, width).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def _confirm(width: int, similarity: float):
    """Rows (a, b, text of a, text of b), by a: the links whose texts are similar."""

    def run(batches):
        last, known = None, set()
        for batch in cut_batches(batches, 3):
            kept = []
            for k, (a, x, y) in enumerate(zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True)):
                if a != last:
                    last, known = a, set(shingle_hashes(x, width).tolist())
                own = set(shingle_hashes(y, width).tolist())
                both = len(own & known)
                if both >= similarity * (len(own) + len(known) - both) - 1e-9:
                    kept.append(k)
            yield batch.select([0, 1]).take(pa.array(kept, pa.int64()))

    return giving_back(run)


def confirmed(docs: DataFrame, links: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of ``links`` (a, b: xxhash64 of texts) whose texts are similar. Only texts of links are moved."""
    ends = links.select(F.explode(F.array("a", "b")).alias("end")).distinct()
    texts = docs.select(F.xxhash64(_body()).alias("node"), _body().alias("body")).join(ends, F.col("node") == F.col("end"), "left_semi")
    texts = texts.groupBy("node").agg(F.first("body").alias("body"))
    # few links share their greater end b; of a hub a, which many may share, adaptive execution splits the join
    met = links.select("a", "b").join(texts.select(F.col("node").alias("b"), F.col("body").alias("y")), "b")
    met = met.join(texts.select(F.col("node").alias("a"), F.col("body").alias("x")), "a").select("a", "b", "x", "y")
    return met.sortWithinPartitions("a").mapInArrow(_confirm(width, similarity), _EXACT)


def similar_links(docs: DataFrame, printed: DataFrame, scratch: Scratch, width: int, similarity: float, max_diff: int) -> DataFrame:
    """Confirmed links (a, b) between different texts (``node`` of ``printed``) whose components are those of all of them."""
    spark = docs.sparkSession
    nodes = printed.groupBy("node").agg(F.first("fp").alias("fp"), F.first("sketch").alias("sketch"))
    nodes = scratch.table(nodes, "nodes")
    # texts alike in fingerprint and sketch hang on the least of them, so that a group has no equal rows
    least = scratch.table(nodes.groupBy("fp", "sketch").agg(F.min("node").alias("node")), "least")
    alike = nodes.join(least.withColumnRenamed("node", "other"), ["fp", "sketch"]).where("node <> other")
    alike = alike.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), F.lit(1.0).alias("w"))
    schema = "mask long, key long, rank long, fp long, node long, sketch binary"
    zero = F.lit(0).cast("long")
    dealt = least.select(zero.alias("mask"), zero.alias("key"), "fp", "node", "sketch").mapInArrow(_deal_sketches(0), schema)

    def again(rows: DataFrame, turn: int) -> DataFrame | None:
        return rows.select("mask", "key", "fp", "node", "sketch").mapInArrow(_deal_sketches(turn), schema) if turn <= REFINE else None

    near = _grouped(spark, dealt, again, scratch).mapInArrow(_links(max_diff, True), _LIKELY).unionByName(alike)
    links = scratch.table(near.groupBy("a", "b").agg(F.max("w").alias("w")), "likely")
    # first the link of each text to its least neighbour: one or none a text, and copies of one text share a hub
    chosen = links.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("a")).select(F.col("a").alias("a"), F.col("x").alias("b"))
    good, tried, turn = None, None, 0
    while True:
        chosen = scratch.table(chosen, f"chosen-{turn}")
        told = scratch.table(confirmed(docs, chosen, width, similarity), f"confirmed-{turn}")
        good = told if good is None else good.unionByName(told)
        tried = chosen if tried is None else tried.unionByName(chosen)
        stars = components(good, Scratch(spark, f"simhash-{turn}"))
        root = lambda c: stars.select(F.col("node").alias(f"{c}_node"), F.col("root").alias(f"{c}_root"))
        open_ = links.join(tried, ["a", "b"], "left_anti").join(root("a"), F.col("a") == F.col("a_node"), "left").join(root("b"), F.col("b") == F.col("b_node"), "left")
        ra, rb = F.coalesce("a_root", "a"), F.coalesce("b_root", "b")
        open_ = open_.where(ra != rb).select(F.least(ra, rb).alias("p"), F.greatest(ra, rb).alias("q"), F.struct("w", "a", "b").alias("link"))
        chosen, turn = open_.groupBy("p", "q").agg(F.max("link").alias("link")).select("link.a", "link.b"), turn + 1
        if chosen.isEmpty():
            return stars


def similar_documents(docs: DataFrame, keep: Sequence[str] = (), width: int = 5, similarity: float = 0.8, max_diff: int = WIDE_DIFF) -> DataFrame:
    """doc_id, ``keep``, node (xxhash64 of the text), root (a node, one for each component), component_id (least doc_id reachable).

    64-bit hashes of texts stand for them (two of n texts are taken for one in about n^2 / 2^65 cases).
    """
    scratch = Scratch(docs.sparkSession, "similar")
    told = [F.col("doc_id"), *map(F.col, keep), F.xxhash64(_body()).alias("node")]
    printed = scratch.table(_printed(docs, told, width, True), "printed")
    stars = similar_links(docs, printed, scratch, width, similarity, max_diff)
    codes = printed.groupBy("node").agg(F.min("doc_id").alias("least"))
    return _labelled(printed, codes, stars, "node").select("doc_id", *keep, "node", "root", "component_id")


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
