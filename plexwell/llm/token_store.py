"""Content-addressed store of token ids.

A document's ids (the end id included) are cut where a gear hash rolled over the last 16 ids has its low bits clear,
so equal passages give equal chunks wherever they stand. A chunk is stored once, under the BLAKE2b digest of its
bytes; a document is a recipe of digests. Three Parquet tables make up a store:

``pack/kind=chunk``   digest, payload (ids as little-endian 16 or 32 bits), each digest once;
``recipe``            part, row, doc_id, n_tokens, start_in_part, digests, lengths, root (Merkle root over the digests),
                      by ascending doc_id;
``manifest``          part, first_id (ids before the part), n_tokens, root (Merkle root over the part's documents).

Null texts are empty; an empty text is one end id. Rows with equal or null doc_id are separate documents (null sorts
first). An empty table gives an empty store. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, cut_batches, freeing, giving_back, shuffle_parts
from .tokens import encoder

MIN_CHUNK, MEAN_BITS, MAX_CHUNK, WINDOW = 64, 8, 1024, 16
DIGEST_BYTES = 20
#: Digests a task remembers so as not to send a chunk twice (only saves shuffle; the shuffle drops the rest).
SEEN = 500_000
_GEAR = np.random.default_rng(20240229).integers(0, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def boundaries(ids: np.ndarray, lengths: list[int]) -> list[list[int]]:
    """Chunk lengths of each document; ``ids`` holds the documents one after another.

    The hash of a place covers WINDOW ids, fewer than MIN_CHUNK, so a neighbouring document never decides a cut.
    """
    h = _GEAR[ids & 0xFFFF]
    width = 1
    while width < WINDOW:
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width] << np.uint64(width)
        h = h + shifted
        width *= 2
    # the low bits of a sum of left shifts depend on the latest ids only; the high ones of a window depend on all
    cuts = np.flatnonzero(h & np.uint64(((1 << MEAN_BITS) - 1) << (WINDOW - 1)) == 0) + 1
    out, base = [], 0
    at = np.searchsorted(cuts, np.cumsum([0, *lengths])).tolist()
    for k, n in enumerate(lengths):
        sizes, last = [], 0
        for c in cuts[at[k] : at[k + 1]].tolist():
            c -= base
            while c - last > MAX_CHUNK:
                sizes.append(MAX_CHUNK)
                last += MAX_CHUNK
            if c - last >= MIN_CHUNK and c < n:
                sizes.append(c - last)
                last = c
        while n - last > MAX_CHUNK:
            sizes.append(MAX_CHUNK)
            last += MAX_CHUNK
        sizes.append(n - last)
        out.append(sizes)
        base += n
    return out


def digest(payload: bytes) -> bytes:
    return blake2b(payload, digest_size=DIGEST_BYTES).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """Root of a binary Merkle tree; leaves and nodes are hashed under different prefixes, an odd node moves up."""
    level = [digest(b"\0" + x) for x in leaves] or [digest(b"")]
    while len(level) > 1:
        odd = level[-1:] if len(level) % 2 else []
        level = [digest(b"\1" + a + b) for a, b in zip(level[::2], level[1::2], strict=False)] + odd
    return level[0]


_PACK = "kind string, key binary, payload binary, doc_id long, n_tokens long, digests array<binary>, lengths array<int>"
_RECIPE = "part int, row long, doc_id long, n_tokens long, start_in_part long, digests array<binary>, lengths array<int>, root binary"


def _encode(path: str, end_id: int, narrow: bool):
    width = "<u2" if narrow else "<u4"

    def run(batches):
        enc, seen, part, row = encoder(path), set(), TaskContext.get().partitionId(), 0
        for batch in cut_batches(batches, 1):
            docs = batch.column(0).to_pylist()
            found, counts = enc.encode_all(batch.column(1))
            ends = np.cumsum(counts)
            coded, lengths = np.insert(found, ends, end_id), (counts + 1).tolist()
            ends = [0, *(ends + np.arange(1, len(ends) + 1)).tolist()]
            if narrow and coded.max(initial=0) > 0xFFFF:
                raise ValueError("an id of the tokenizer does not fit in 16 bits")
            for i in range(0, len(docs), 256):
                sizes_here = lengths[i : i + 256]
                ids = coded[ends[i] : ends[min(i + 256, len(docs))]]
                raw = ids.astype(width).tobytes()
                step, at = ids.itemsize // (2 if narrow else 1), 0
                fresh: dict[bytes, bytes] = {}
                heads, sums, recipes, cuts = [], [], [], boundaries(ids, sizes_here)
                for sizes in cuts:
                    keys = []
                    for n in sizes:
                        payload = raw[at : (at := at + n * step)]
                        key = blake2b(payload, digest_size=DIGEST_BYTES).digest()
                        keys.append(key)
                        if key not in seen:
                            fresh[key] = payload
                    heads.append(part.to_bytes(4, "big") + row.to_bytes(8, "big"))
                    sums.append(sum(sizes))
                    recipes.append(keys)
                    row += 1
                if len(seen) < SEEN:
                    seen.update(fresh)
                none, rows = [None] * len(fresh), len(cuts)
                cols = {
                    "kind": ["chunk"] * len(fresh) + ["doc"] * rows, "key": [*fresh, *heads], "payload": [*fresh.values(), *[None] * rows],
                    "doc_id": none + docs[i : i + 256], "n_tokens": none + sums, "digests": none + recipes, "lengths": none + cuts,
                }
                yield _batch(cols, _PACK)

    return run


def _batch(cols: dict[str, list], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}
    fields = [f.split(" ", 1) for f in ddl.split(", ")]
    return pa.record_batch([pa.array(cols[n], kinds[k]) for n, k in fields], names=[n for n, _ in fields])


def _number(batches):
    """Rows of one part, already by doc_id: running starts and each document's Merkle root."""
    part, row, start = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        x = batch.to_pydict()
        n = batch.num_rows
        starts = []
        for t in x["n_tokens"]:
            starts.append(start)
            start += t
        cols = x | {"part": [part] * n, "row": list(range(row, row + n)), "start_in_part": starts, "root": [merkle(d) for d in x["digests"]]}
        row += n
        yield _batch(cols, _RECIPE)


def _roots(batches):
    """One row for a part: its size and the Merkle root over its documents (they come by part and row)."""
    part, tokens, roots = None, 0, []
    for batch in batches:
        for p, n, root in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if p != part and part is not None:
                yield _batch({"part": [part], "n_tokens": [tokens], "root": [merkle(roots)]}, "part int, n_tokens long, root binary")
                tokens, roots = 0, []
            part, tokens = p, tokens + n
            roots.append(root)
    if part is not None:
        yield _batch({"part": [part], "n_tokens": [tokens], "root": [merkle(roots)]}, "part int, n_tokens long, root binary")


def _summed(recipes: DataFrame) -> list[tuple[int, int, int, bytes]]:
    """part, first_id, n_tokens, Merkle root of each part of ``recipes``; as many rows as parts, whatever the input."""
    parts = shuffle_parts(recipes.sparkSession)
    sums = (
        recipes.select("part", "row", "n_tokens", "root").repartition(parts, "part").sortWithinPartitions("part", "row")
        .select("part", "n_tokens", "root").mapInArrow(_roots, "part int, n_tokens long, root binary")
    )
    rows, first, listed = sorted(sums.collect(), key=lambda r: r["part"]), 0, []
    for r in rows:
        listed.append((r["part"], first, r["n_tokens"], bytes(r["root"])))
        first += r["n_tokens"]
    return listed


class TokenStore:
    """A written store; ``chunks``, ``recipes`` and ``manifest`` are its tables, read from its files."""

    def __init__(self, chunks: DataFrame, recipes: DataFrame, manifest: DataFrame, narrow: bool):
        self.chunks, self.recipes, self.manifest, self.narrow = chunks, recipes, manifest, narrow


def write_store(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 0, scratch: Scratch | None = None, max_id: int | None = None) -> TokenStore:
    """Tokenise ``docs`` (doc_id, text) and write a store. ``max_id``: ids lie below it (None: as the tokenizer says); 16 bits hold them if they can."""
    scratch = scratch or Scratch(spark, "token-store")
    if max_id is None:
        max_id = max(end_id, largest_id(path)) + 1
    narrow = max_id <= 1 << 16
    coded = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(_encode(path, end_id, narrow)), _PACK)
    # one shuffle by digest serves both tables: a chunk meets its copies, a recipe has a key of its own
    once = coded.groupBy("kind", "key").agg(*(F.first(c).alias(c) for c in ("payload", "doc_id", "n_tokens", "digests", "lengths")))
    with freeing(spark):
        once.write.option("compression", "zstd").partitionBy("kind").parquet(scratch.path("pack"))
    pack = spark.read.schema(once.schema).parquet(scratch.path("pack"))
    chunks = pack.where("kind = 'chunk'").select(F.col("key").alias("digest"), "payload")
    # salted by the row key, so that even one doc_id on many rows is dealt over parts
    ordered = (
        pack.where("kind = 'doc'")
        .select("doc_id", "n_tokens", "digests", "lengths", "key")
        .repartitionByRange(shuffle_parts(spark), F.col("doc_id").asc_nulls_first(), "key")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "key")
    )
    recipes = scratch.table(ordered.drop("key").mapInArrow(_number, _RECIPE), "recipe")
    listed = _summed(recipes)
    manifest = scratch.table(spark.createDataFrame(listed, "part int, first_id long, n_tokens long, root binary"), "manifest")
    return TokenStore(chunks, recipes, manifest, narrow)


def largest_id(path: str) -> int:
    """The largest id that the tokenizer of a file gives."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values(), default=0)


def crc_shift(n_bytes: int) -> int:
    """x to the power of 8 ``n_bytes`` modulo the CRC-32 polynomial, in reflected bits."""
    out, factor = 1 << 31, 1 << 23
    while n_bytes:
        if n_bytes & 1:
            out = _times(out, factor)
        factor = _times(factor, factor)
        n_bytes >>= 1
    return out


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo CRC-32's."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return out


def _times_all(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_times`` of many pairs."""
    out, b = np.zeros_like(a), b.copy()
    for k in range(31, -1, -1):
        out ^= b * (a >> np.uint32(k) & np.uint32(1))
        b = (b >> np.uint32(1)) ^ np.uint32(0xEDB88320) * (b & np.uint32(1))
    return out


class _Shifts:
    """``crc_shift`` of numbers of ids, as that of the nearest multiple of NEAR below and of the rest."""

    NEAR = 1024

    def __init__(self):
        self.near, self.far, self.step = self._powers([1 << 31], crc_shift(4), self.NEAR), [1 << 31], crc_shift(4 * self.NEAR)

    @staticmethod
    def _powers(known: list[int], step: int, n: int) -> list[int]:
        while len(known) < n:
            known.append(_times(known[-1], step))
        return known

    def apply(self, crc: np.ndarray, n_ids: np.ndarray) -> np.ndarray:
        """Each checksum's share in that of a text in which so many ids come after its own."""
        high, low = np.divmod(n_ids, self.NEAR)
        self._powers(self.far, self.step, int(high.max(initial=0)) + 1)
        out, far = _times_all(crc, np.array(self.near, np.uint32)[low]), np.flatnonzero(high)
        out[far] = _times_all(out[far], np.array(self.far, np.uint32)[high[far]])
        return out


def _chunk_facts(narrow: bool):
    def run(batches):
        for batch in batches:
            keys, crcs, sizes = batch.column(0).to_pylist(), [], []
            for key, payload in zip(keys, batch.column(1).to_pylist(), strict=True):
                if blake2b(payload, digest_size=DIGEST_BYTES).digest() != key:
                    raise ValueError(f"chunk {key.hex()} does not hold what its address says")
                wide = np.frombuffer(payload, "<u2").astype("<u4") if narrow else payload
                sizes.append(len(payload) // (2 if narrow else 4))
                crcs.append(zlib.crc32(wide))
            yield _batch({"digest": keys, "n": sizes, "crc": crcs}, "digest binary, n int, crc long")

    return run


def _verify(batches):
    """Documents put together from their chunks: lengths and Merkle root must be those of the recipe."""
    shifts = _Shifts()
    for batch in batches:
        if not batch.num_rows:
            continue
        found = batch.column(4)
        each = pc.fill_null(pc.list_value_length(found), 0).to_numpy()
        pos, n, crc, keys = found.flatten().flatten()
        if not each.all() or n.null_count:
            raise ValueError("a document's chunk is not in the store")
        doc = np.repeat(np.arange(len(each)), each)
        order = np.lexsort((pos.to_numpy(), doc))
        n, crc, keys = n.to_numpy()[order].astype(np.int64), crc.to_numpy()[order].astype(np.uint32), keys.take(pa.array(order)).to_pylist()
        ends = np.cumsum(each)
        sums, last = np.add.reduceat(n, ends - each), np.cumsum(n)
        bounds = ends.tolist()
        roots = [merkle(keys[a:b]) for a, b in zip([0, *bounds], bounds, strict=False)]
        if sums.tolist() != batch.column(2).to_pylist() or roots != batch.column(3).to_pylist():
            raise ValueError("a document does not match its recipe")
        # a document's checksum is the sum of its chunks', each moved by the ids that come after it
        crcs = np.bitwise_xor.reduceat(shifts.apply(crc, last[ends - 1][doc] - last), ends - each)
        yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(crcs.astype(np.int64))], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_back(store: TokenStore) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the stored chunks; ValueError if the store isn't whole.

    Every chunk is held against its address, every document's chunks against its root, and the documents of every part against
    the manifest. A chunk's checksum is taken from its stored bytes once; a document's is combined from those of its chunks, so no
    id is moved. Chunks of many copies make one key hot: their join can be split, as nothing groups by it.
    """
    if _summed(store.recipes) != [(r["part"], r["first_id"], r["n_tokens"], bytes(r["root"])) for r in sorted(store.manifest.collect(), key=lambda r: r["part"])]:
        raise ValueError("the recipes do not match the manifest")
    facts = store.chunks.mapInArrow(_chunk_facts(store.narrow), "digest binary, n int, crc long")
    refs = store.recipes.select("part", "row", F.posexplode("digests").alias("pos", "digest"))
    met = refs.join(facts, "digest", "left")
    docs = met.groupBy("part", "row").agg(F.collect_list(F.struct("pos", "n", "crc", "digest")).alias("found"))
    heads = store.recipes.select("part", "row", "doc_id", "start_in_part", "n_tokens", "root").join(store.manifest.select("part", "first_id"), "part")
    return (
        heads.join(docs, ["part", "row"], "left")
        .select("doc_id", (F.col("first_id") + F.col("start_in_part")).alias("start"), "n_tokens", "root", "found")
        .mapInArrow(_verify, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def read_ids(store: TokenStore) -> DataFrame:
    """doc_id, start and the ids themselves (array<int>), put together from chunks."""
    refs = store.recipes.select("part", "row", F.posexplode("digests").alias("pos", "digest"))
    docs = refs.join(store.chunks, "digest", "left").groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("pos", "payload"))).alias("found"))
    heads = store.recipes.join(store.manifest.select("part", "first_id"), "part").select("part", "row", "doc_id", (F.col("first_id") + F.col("start_in_part")).alias("start"))
    width = "<u2" if store.narrow else "<u4"

    def join(batches):
        for batch in batches:
            rows = batch.column(2).to_pylist()
            if any(found is None or any(f["payload"] is None for f in found) for found in rows):
                raise ValueError("a document's chunk is not in the store")
            ids = [np.frombuffer(b"".join(f["payload"] for f in found), width).astype("i4") for found in rows]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "start", "ids"])

    return heads.join(docs, ["part", "row"], "left").select("doc_id", "start", "found").mapInArrow(join, "doc_id long, start long, ids array<int>")
