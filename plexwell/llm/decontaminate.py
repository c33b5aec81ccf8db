"""Benchmark decontamination with a generalised suffix automaton.

One automaton holds the words of a block of benchmark items. A document's words run through it; the state and the
length of the longest match ending at each word tell which item windows end there. A word is hit if an occurrence of a
window covers it: ``window`` consecutive item words, or a whole item that has fewer.

Only words that some item has can match, so a document goes through the automaton only where enough known pairs of
words follow one another. Items come in blocks of bounded size, each against all documents.

Null and empty texts have no words. Rows with equal or null doc_id are handled each for themselves; items with a null
item_id are ignored, those with one item_id on several rows count once. Empty tables give no rows or no hits. Columns
other than the ids and texts and those of ``keep`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, cut_batches, giving_back, share

#: Bytes of item text in one automaton (some hundred MB of Python objects at most).
BLOCK_BYTES = 4 << 20
#: Separators to spaces, A-Z to a-z; 0-9, a-z and bytes of 128 and more are word bytes.
_WORDS = bytes(LOWER[b] if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_SPAN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Automaton:
    """Generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for i, ws in items if ws]
        for _, ws in coded:
            last = 0
            for c in ws:
                last = self._extend(last, c)
        n = len(self.length)
        order = sorted(range(1, n), key=self.length.__getitem__)
        # for each state, the suffix state whose strings include the one of `window` words
        self.at_window = [-1] * n
        for v in order:
            if self.length[v] >= window:
                self.at_window[v] = v if self.length[self.link[v]] < window else self.at_window[self.link[v]]
        self.window_items: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for item, ws in coded:
            v = 0
            for k, c in enumerate(ws):
                v = self.next[v][c]
                if k + 1 >= window:
                    self.window_items.setdefault(self.at_window[v], set()).add(item)
            if len(ws) < window:
                short.setdefault(v, set()).add((len(ws), item))
        # for each state, whole short items among its suffixes: those of the state itself, then those of its links
        self.short = short
        self.next_short = [-1] * n
        for v in order:
            self.next_short[v] = v if v in short else self.next_short[self.link[v]]
        self.least = min((min(len(ws), window) for _, ws in coded), default=0)
        v = len(self.vocab)
        self.pairs = np.unique(np.array([a * v + b for _, ws in coded for a, b in zip(ws, ws[1:], strict=False)], np.int64))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(length)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        link[q] = new
        return new

    def ranges(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where a window can lie: runs of known words whose every pair occurs in an item, long enough for one."""
        known = ids >= 0
        if self.least > 1:
            both = known[:-1] & known[1:]
            if not both.any():
                return []
            at = np.flatnonzero(both)
            code = ids[at] * len(self.vocab) + ids[at + 1]
            found = np.searchsorted(self.pairs, code)
            found[found == len(self.pairs)] = 0
            both[at] = self.pairs[found] == code
            flags, extra = both, 1
        else:
            flags, extra = known, 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
        return [(int(a), int(b) + extra) for a, b in zip(edge[::2], edge[1::2], strict=True) if b - a + extra >= self.least]

    def search(self, ids: list[int], base: int, hits: list[tuple[int, int]], items: set[str]) -> int:
        """Add hit ranges and items of ``ids``, which starts at word ``base``; the longest match."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        v = n = longest = 0
        for i, c in enumerate(ids, base + 1):
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                n = 0
            longest = max(longest, n)
            if n >= window:
                items |= self.window_items[self.at_window[v]]
                hits.append((i - window, i))
            u = self.next_short[v]
            while u > 0:
                for k, item in self.short[u]:
                    if k <= n:
                        items.add(item)
                        hits.append((i - k, i))
                u = self.next_short[link[u]]
        return longest


def _merge(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = "n_words long, hits array<struct<a:int,b:int>>, items array<string>, longest int"


def _scan(shared, passed: int, only_hits: bool):
    """The first ``passed`` columns go through as they are; the last column is the text as bytes."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches):
        auto: Automaton = shared.value
        get = auto.vocab.get
        for batch in cut_batches(batches, -1):
            cols: list[list] = [[], [], [], []]
            where = []
            for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                ws = words_of(text)
                hits: list[tuple[int, int]] = []
                items: set[str] = set()
                longest = 0
                if auto.vocab and len(ws) >= auto.least:
                    ids = np.fromiter(map(get, ws, repeat(-1)), np.int64, len(ws))
                    for a, b in auto.ranges(ids):
                        longest = max(longest, auto.search(ids[a:b].tolist(), a, hits, items))
                if only_hits and not hits:
                    continue
                where.append(row)
                for c, v in zip(cols, (len(ws), [{"a": a, "b": b} for a, b in _merge(hits)], sorted(items), longest), strict=True):
                    c.append(v)
            through = batch.select(list(range(passed)))
            through = through.take(pa.array(where, pa.int64())) if only_hits else through
            arrays = list(through.columns)
            arrays += [pa.array(c, k) for c, k in zip(cols, (pa.int64(), kind, pa.list_(pa.string()), pa.int32()), strict=True)]
            yield pa.record_batch(arrays, names=[*through.schema.names, "n_words", "hits", "items", "longest"])

    return giving_back(run)


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = (), window: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ``keep``, body (the text as bytes), n_words, hits (word ranges a to b-1), items (sorted), longest."""
    spark = docs.sparkSession
    told = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body")).where("item is not null")
    size = told.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    told = told.withColumn("block", F.pmod(F.xxhash64("item", "body"), F.lit(blocks)))
    # md5 of the text tells rows of one doc_id apart where several blocks are put together
    docs = docs.select("doc_id", *keep, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)

    def shared(block: int):
        rows = told.where(F.col("block") == block).collect()  # about block_bytes
        return share(spark, Automaton([(r["item"], words_of(bytes(r["body"]))) for r in rows], window))

    n = len(docs.columns)
    schema = f"{kinds}, {_FOUND}"
    if blocks == 1:
        return docs.mapInArrow(_scan(shared(0), n, False), schema)
    parts = None
    keyed = docs.select(F.struct("doc_id", F.md5("body").alias("sum")).alias("row"), "body")
    for block in range(blocks):
        part = keyed.mapInArrow(_scan(shared(block), 1, True), f"row struct<doc_id:long,sum:string>, {_FOUND}")
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("row").agg(F.flatten(F.collect_set("hits")).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"), F.max("longest").alias("longest"))
    empty = share(spark, Automaton([], window))
    counted = docs.mapInArrow(_scan(empty, n, False), schema).drop("hits", "items", "longest").withColumn("row", F.struct("doc_id", F.md5("body").alias("sum")))
    # ranges of several blocks may overlap: sorted, then folded into disjoint ones
    fold = F.aggregate(
        F.array_sort("hits"), F.array().cast("array<struct<a:int,b:int>>"),
        lambda out, x: F.when((F.size(out) > 0) & (F.element_at(out, -1)["b"] >= x["a"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["a"].alias("a"), F.greatest(F.element_at(out, -1)["b"], x["b"]).alias("b"))))).otherwise(F.concat(out, F.array(x))),
    )
    met = counted.alias("c").join(merged.alias("m"), F.col("c.row").eqNullSafe(F.col("m.row")), "left")
    return met.select(
        *(f"c.{x}" for x in ["doc_id", *keep, "body", "n_words"]), F.coalesce(fold, F.array().cast("array<struct<a:int,b:int>>")).alias("hits"),
        F.coalesce("m.items", F.array().cast("array<string>")).alias("items"), F.coalesce("m.longest", F.lit(0)).alias("longest"),
    )


def n_hit(hits="hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])


def _without(batches):
    """text and hits (the last two columns) to the text without those words; what stood between them goes too."""
    for batch in cut_batches(batches, -2):
        out = []
        for body, hits in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            if hits:
                at = [m.span() for m in _SPAN.finditer(body)]
                kept, last = [], 0
                for h in hits:
                    kept.append(body[last : at[h["a"]][0]])
                    last = at[h["b"] - 1][1]
                body = b"".join([*kept, body[last:]])
            out.append(body.decode())
        n = batch.num_columns - 2
        yield pa.record_batch([*(batch.column(i) for i in range(n)), pa.array(out, pa.string())], names=[*batch.column_names[:n], "text"])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = (), window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """doc_id, ``keep``, text without hit spans; a document of which more than ``max_coverage`` of the words is hit goes."""
    found = find_contamination(docs, benchmark, keep, window).where(n_hit() <= F.col("n_words") * max_coverage)
    kept = found.select("doc_id", *keep, "body", "hits")
    kinds = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes[:-2])
    return kept.mapInArrow(giving_back(_without), f"{kinds}, text string")


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit() > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """The contract word by word, for tests: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins: dict[tuple, set[str]] = {}
    for item, text in items:
        ws = split(text)
        if item is not None and ws:
            k = min(window, len(ws))
            for i in range(len(ws) - k + 1):
                wins.setdefault(tuple(ws[i : i + k]), set()).add(str(item))
    out = []
    for doc, text in docs:
        ws = split(text)
        hit, found = set(), set()
        for i in range(len(ws)):
            for k in range(1, window + 1):
                if i + k <= len(ws) and (got := wins.get(tuple(ws[i : i + k]))):
                    hit.update(range(i, i + k))
                    found |= got
        out.append((doc, len(ws), len(hit), len(found), sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def _sql(window: int = 10) -> str:
    upper = "".join(map(chr, range(65, 91)))
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS ws FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item, ws, least({window}, len(ws)) AS k FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(ws[i + 1 : i + k], ' ') AS win FROM (SELECT item, ws, k, unnest(range(len(ws) - k + 1)) AS i FROM s) x),
dw AS (SELECT r, i, k, array_to_string(ws[i + 1 : i + k], ' ') AS win FROM (SELECT r, ws, k, unnest(range(len(ws) - k + 1)) AS i FROM w JOIN (SELECT DISTINCT k FROM bw) ks ON len(ws) >= k) x),
m AS (SELECT r, i, dw.k, item FROM dw JOIN bw ON dw.k = bw.k AND dw.win = bw.win),
h AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM m) x GROUP BY r),
t AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) x GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON w.r = h.r LEFT JOIN t ON w.r = t.r
"""


SQL_OP5 = _sql()
