"""Quality classifier: a generalised additive model with pairwise interactions.

Every whole text gives a row of surface features. Shallow trees are boosted in turns, one feature at a time, on the
histogram of the residuals; each adds to its feature's lookup table, so the model is a table for each feature and for
the pairs that explain most of what the single features leave. A score is the sum of looked-up bins through a sigmoid.

Null and empty texts have the features of an empty text. Rows with equal or null doc_id are scored each for themselves; a label
row counts once for each document row it meets. Labels that are null don't count; without any label every score is 0.5.
An empty table gives no rows. Columns other than the id, the text and those of ``keep`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_batches, giving_back, id_crc, share, text_bytes

#: Labelled rows the model is fitted on at most; labels are drawn by the hash of doc_id. Only fitting is bounded.
MAX_LABELLED = 100_000
BINS, ROUNDS, PAIRS, PAIR_ROUNDS, PAIR_BINS, RATE = 32, 120, 6, 60, 8, 0.15

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "space", "newline", "high_bytes", "stop_mark", "comma", "exclamation", "question",
    "symbols", "bar", "brackets", "quotes", "other_punct", "distinct_words", "distinct_lines", "words_per_line", "words_per_stop", "caps_words",
    "one_letter", "long_words", "top_word", "trailing_punct",
)

_CLASSES = np.zeros(256, np.int64)
_NAMES = ("lower", "upper", "digit", "space", "newline", "high", "stop", "comma", "excl", "quest", "symbol", "bar", "bracket", "quote", "other")
for _b in range(256):
    _c = chr(_b)
    _CLASSES[_b] = _NAMES.index(
        "high" if _b > 127 else "lower" if "a" <= _c <= "z" else "upper" if "A" <= _c <= "Z" else "digit" if "0" <= _c <= "9" else "newline" if _c == "\n"
        else "space" if _c.isspace() else "stop" if _c == "." else "comma" if _c == "," else "excl" if _c == "!" else "quest" if _c == "?"
        else "symbol" if _c in "#$%&*@^~+=<>_" else "bar" if _c in "|\\/" else "bracket" if _c in "()[]{}" else "quote" if _c in "'\"`" else "other"
    )


def features(text: bytes) -> tuple[float, ...]:
    """FEATURES of a whole text."""
    n = len(text)
    by = np.bincount(_CLASSES, np.bincount(np.frombuffer(text, np.uint8), minlength=256), len(_NAMES)) if n else np.zeros(len(_NAMES))
    lower, upper, digit, space, newline, high, stop, comma, excl, quest, symbol, bar, bracket, quote, other = (by / max(n, 1)).tolist()
    words = text.split()
    w = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    lines = text.split(b"\n")
    caps = sum(k for x, k in counts.items() if len(x) > 1 and x.isupper()) / w
    one = sum(k for x, k in counts.items() if len(x) == 1) / w
    long = sum(k for x, k in counts.items() if len(x) > 12) / w
    tail = sum(k for x, k in counts.items() if 32 < x[-1] < 127 and not x[-1:].isalnum()) / w
    return (
        math.log1p(n), math.log1p(len(words)), (n - by[3] - by[4]) / w if n else 0.0, upper, digit, space, newline, high, stop, comma, excl, quest,
        symbol, bar, bracket, quote, other, len(counts) / w, len(set(lines)) / len(lines), len(words) / len(lines), len(words) / (by[6] + 1), caps,
        one, long, max(counts.values(), default=0) / w, tail,
    )


class Additive:
    """Lookup tables: ``edges[j]`` bin feature j, ``tables[j]`` holds its terms, ``pairs`` (i, j, coarse edges, table)."""

    def __init__(self, edges: list[np.ndarray], base: float, tables: list[np.ndarray], pairs: list[tuple]):
        self.edges, self.base, self.tables, self.pairs = edges, base, tables, pairs

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            out += t[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for i, j, ei, ej, t in self.pairs:
            out += t[np.searchsorted(ei, x[:, i], side="right"), np.searchsorted(ej, x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -35, 35)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="higher"))


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    return g / (h + ridge)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins (place 0: none)."""
    if len(g) < 2:
        return 0.0, 0
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    rg, rh = g.sum() - cg, h.sum() - ch
    gain = cg * _leaf(cg, ch) + rg * _leaf(rg, rh) - g.sum() * _leaf(g.sum(), h.sum())
    gain = np.where((ch >= 0.5) & (rh >= 0.5), gain, 0.0)
    k = int(gain.argmax())
    return float(gain[k]), k + 1 if gain[k] > 0 else 0


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """The value of each bin under a tree of a few leaves, grown at the best cut."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        cuts = [_best_cut(g[a:b], h[a:b]) for a, b in spans]
        k = max(range(len(spans)), key=lambda i: cuts[i][0])
        if not cuts[k][1]:
            break
        a, b = spans.pop(k)
        spans += [(a, a + cuts[k][1]), (a + cuts[k][1], b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of depth two over a grid: a cut of one axis, then one of the other in each half; its gain and values."""
    best = (0.0, np.zeros_like(g))
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        for cut in range(1, len(gg)):
            out, gain = np.zeros_like(gg), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                a, b = gg[rows].sum(axis=0), hh[rows].sum(axis=0)
                _, k = _best_cut(a, b)
                for cols in (slice(0, k), slice(k, None)) if k else (slice(0, None),):
                    v = _leaf(a[cols].sum(), b[cols].sum())
                    out[rows, cols] = v
                    gain += v * a[cols].sum()
            if gain > best[0]:
                best = (gain, out.T if turn else out)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Fit on features ``x`` and labels ``y`` (0 or 1); the order of rows doesn't matter but for rounding."""
    p = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = math.log(p / (1 - p))
    if len(y) == 0 or y.min() == y.max():
        return Additive([np.zeros(0)] * x.shape[1], base, [np.zeros(1)] * x.shape[1], [])
    edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    f = np.full(len(y), base)
    for _ in range(ROUNDS):
        for j, table in enumerate(tables):
            q = 1 / (1 + np.exp(-f))
            step = RATE * _tree(np.bincount(at[j], y - q, len(table)), np.bincount(at[j], q * (1 - q), len(table)))
            table += step
            f += step[at[j]]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    cells = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

    def grid(i: int, j: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        cell = cells[i] * shape[1] + cells[j]
        return np.bincount(cell, y - q, shape[0] * shape[1]).reshape(shape), np.bincount(cell, q * (1 - q), shape[0] * shape[1]).reshape(shape)

    q = 1 / (1 + np.exp(-f))
    gains = sorted(((_grid_tree(*grid(i, j, q))[0], i, j) for i, j in combinations(range(x.shape[1]), 2)), reverse=True)[:PAIRS]
    pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for g, i, j in gains if g > 0]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, table in pairs:
            step = RATE * _grid_tree(*grid(i, j, 1 / (1 + np.exp(-f))))[1]
            table += step
            f += step[cells[i], cells[j]]
    return Additive(edges, base, tables, pairs)


def _describe(batches):
    for batch in cut_batches(batches, 1):
        rows = [features(t) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) if len(column) else np.zeros((0, len(FEATURES)))


def fit_on(described: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Additive:
    """The model of labelled rows that aren't held out. ``described``: doc_id, x."""
    told = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where("y in (0, 1)").where(F.pmod(id_crc("doc_id"), F.lit(3)) != 1)
    # about as many labels as the bound, by hash; the rows of one doc_id stay together
    share_of = min(1.0, max_labelled / max(1, told.count()))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    rows = told.where(drawn < int(share_of * (1 << 30))).join(described.select("doc_id", "x"), "doc_id").select("doc_id", "y", "x")
    # a doc_id may stand on many rows: only then does the limit cut, after all but the drawn rows are gone
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_labelled).toArrow().combine_chunks()
    x = np.array(sample.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, np.array(sample.column("y").to_pylist(), np.float64))


def score(docs: DataFrame, labels: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; with ``keep``, these columns too."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    described = scratch.table(text_bytes(docs, "doc_id").mapInArrow(_describe, "doc_id long, x array<double>"), "features")
    model = share(spark, fit_on(described, labels))  # a few tables of at most BINS entries
    if not keep:

        def run(batches):
            for batch in batches:
                s = model.value.score(_matrix(batch.column(1)))
                yield pa.record_batch([batch.column(0), pa.array(s)], names=["doc_id", "score"])

        scored = described.mapInArrow(run, "doc_id long, score double")
    else:
        # the text goes to Python once: as its own column if it is kept, else as bytes
        own = [F.col("text")] if "text" in keep else [F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body")]
        told = docs.select("doc_id", *(c for c in keep if c != "text"), *own)
        n = len(told.columns) - ("text" not in keep)
        kinds = ", ".join(f"`{c}` {t}" for c, t in told.dtypes[:n])

        def run(batches):
            for part in cut_batches(batches, -1):
                x = [features(t.encode() if isinstance(t, str) else t or b"") for t in part.column(part.num_columns - 1).to_pylist()]
                scores = model.value.score(np.array(x).reshape(-1, len(FEATURES)))
                yield pa.record_batch([*(part.column(i) for i in range(n)), pa.array(scores)], names=[*part.column_names[:n], "score"])

        scored = told.mapInArrow(giving_back(run), f"{kinds}, score double")
    return scored.withColumns({"held_out": F.pmod(id_crc("doc_id"), F.lit(3)) == 1, "predicted": (F.col("score") >= 0.5).cast("int")})


def op3_quality(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")
