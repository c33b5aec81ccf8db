"""Exact tokenisation of whole batches, each unit between spaces once.

A byte-pair model works on pre-tokens, and no pre-token of the supported tokenizers runs across a single space, so a
text's ids are the ids of its space-separated units in order. A batch's texts are split and their units numbered by Arrow;
each different unit is looked up once in a cache of bounded bytes, and a text's ids are gathered by number. Units that are not
kept are cut to pre-tokens by the classes of their bytes where these tell, else by the pattern. A text where that rule might not
hold goes through the whole tokenizer.
"""

from __future__ import annotations

import gc
import json
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterable
from itertools import accumulate, chain, islice, pairwise
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units of up to WIDTH bytes are kept, in two tables of SLOTS places (32 bytes each) for as many entries as LOAD of them; MOST_IDS: ids of an entry at most.
#: So both take 64 MB and 88 MB at worst for ids (about 20 MB at 3.5 ids a unit). Other pre-tokens: at most PIECES in each of two dicts, of 280 bytes at most.
WIDTH, SLOTS, LOAD, MOST_IDS, PIECES = 24, 1 << 20, 0.7, 15, 30_000
#: Pre-tokens that the model tells at a time; MANY times as many units are cut at a time.
SOME, MANY = 16384, 8
_ID = attrgetter("id")


#: Marks that are pre-tokens of their own after a word (apostrophes may start a contraction).
_MARKS = frozenset(".,;:!?")
#: All letters below U+0250, where the character tables of two regex engines can't differ.
_LETTERS = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch


#: What a byte of UTF-8 belongs to: 1 letters (two bytes up to U+023F, and what follows a first byte), 2 digits, 3 marks, 4 white space; 0: only a regex tells.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = 1
_KIND[48:58] = 2
_KIND[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3  # no apostrophe
_KIND[[9, 10, 13]] = 4
#: The bytes of a key that a text of so many bytes fills.
_FILLED = (np.arange(WIDTH) < np.arange(WIDTH + 1)[:, None]).astype(np.uint8) * np.uint8(255)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places first, first + 1, ... of each run, one run after another."""
    ends = np.cumsum(count)
    return np.repeat(first - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts and the last ends in a buffer, and the buffer up to there."""
    starts = np.frombuffer(texts.buffers()[1], np.int32 if texts.type == pa.string() else np.int64, len(texts) + 1 + texts.offset)[texts.offset :]
    return starts, np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: starts[-1]]


def _keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each text as WIDTH / 8 words, filled with zeros, and whether the text is told by them (short, not empty, without a zero)."""
    starts, data = _bytes(texts)
    size = np.diff(starts)
    shown = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(WIDTH, np.uint8))), WIDTH)[starts[:-1]].view(np.uint64)
    shown &= _FILLED.view(np.uint64)[np.minimum(size, WIDTH)]
    told = (size > 0) & (size <= WIDTH)
    if not data.all():
        told &= np.count_nonzero(shown.view(np.uint8), axis=1) == size
    return shown, told


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which keys are equal, place by place."""
    same = a[:, 0] == b[:, 0]
    for k in range(1, a.shape[1]):
        same &= a[:, k] == b[:, k]
    return same


def _runs(units: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Units without spaces as runs of letters, digits, marks or one white space, how many each has, and of which units these are the pre-tokens.

    They are for the usual byte-level pattern, after a space. Of the other units nothing is given.
    """
    starts, data = _bytes(units)
    data, size = data[starts[0] :], np.diff(starts)
    kind = _KIND[data]
    white, odd, plain = kind == 4, kind == 0, size > 0
    opens = starts[:-1][plain] - starts[0]
    odd[1:] |= white[1:] & white[:-1]
    odd[1:] |= (data[:-1] == 0xC3) & (data[1:] & 0xDF == 0x97)  # the signs of multiplication and division among letters
    odd[opens] |= white[opens]
    if odd.any():
        plain[plain] = ~np.logical_or.reduceat(odd, opens)
    if not plain.all():
        within = np.repeat(plain, size)
        data, kind, size = data[within], kind[within], size[plain]
    new, ends = np.ones(len(data), bool), np.cumsum(size)
    new[1:] = kind[1:] != kind[:-1]
    new[ends - size] = True
    edges = np.flatnonzero(new)
    per = np.diff(np.searchsorted(edges, np.append(ends - size, len(data))))
    offsets = np.append(edges, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(edges), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))), per, plain


class _Table:
    """Ids by key with open addressing, all in a few arrays: a place takes 32 bytes, not the hundreds of two Python objects."""

    def __init__(self, bits: int = 12):
        self.bits, self.used, self.n_ids = bits, 0, 0
        self.keys, self.place = np.zeros((1 << bits, WIDTH // 8), np.uint64), np.zeros(1 << bits, np.int64)
        self.ids = np.zeros(1 << bits, np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        h = np.zeros(len(keys), np.uint64)
        for k in range(keys.shape[1]):
            h = (h ^ keys[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Where each key's entry is, or -1."""
        at = self.slots(keys)
        here = self.keys[at]
        same = _equal(here, keys)
        out = np.where(same, self.place[at], -1)
        left = np.flatnonzero(~same & (here[:, 0] != 0))  # no key starts with a zero
        at = at[left]
        while left.size:
            at = (at + 1) & ((1 << self.bits) - 1)
            here = self.keys[at]
            same = _equal(here, keys[left])
            out[left[same]] = self.place[at[same]]
            on = ~same & (here[:, 0] != 0)
            left, at = left[on], at[on]
        return out

    def _settle(self, keys: np.ndarray, place: np.ndarray) -> None:
        left, at = np.arange(len(keys)), self.slots(keys)
        while left.size:
            free = self.keys[at, 0] == 0
            mine, spot = left[free], at[free]
            self.place[spot] = mine  # of several, one is the last
            won = self.place[spot] == mine
            self.keys[spot[won]], self.place[spot[won]] = keys[mine[won]], place[mine[won]]
            on = ~free
            on[np.flatnonzero(free)[~won]] = True
            left, at = left[on], (at[on] + 1) & ((1 << self.bits) - 1)

    def add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Entries of different keys that it doesn't hold; an entry is the place of its first id and how many there are."""
        while self.used + len(keys) > LOAD * (1 << self.bits):
            full = self.keys[:, 0] != 0
            keys_before, place_before = self.keys[full], self.place[full]
            self.bits += 1
            self.keys, self.place = np.zeros((1 << self.bits, WIDTH // 8), np.uint64), np.zeros(1 << self.bits, np.int64)
            self._settle(keys_before, place_before)
        end = self.n_ids + len(ids)
        if end > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.n_ids], np.zeros(max(end, 3 * self.n_ids // 2) - self.n_ids, np.uint32)))
        self.ids[self.n_ids : end] = ids
        self._settle(keys, (self.n_ids + np.cumsum(count) - count) << 8 | count)
        self.used, self.n_ids = self.used + len(keys), end


class _Units:
    """Two tables: when the young one is full, it replaces the old one, and what is used comes back."""

    def __init__(self, slots: int):
        self.most, self.young, self.old = int(LOAD * slots), _Table(), _Table()

    def get(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the texts one after another, how many each has, and which are not kept (0 ids)."""
        keys, told = _keys(texts)
        told = np.flatnonzero(told)
        keys = keys[told]
        place, count, ids = self.young.find(keys), np.zeros(len(texts), np.int64), []
        missed = np.flatnonzero(place < 0)
        back = self.old.find(keys[missed])
        found, back = missed[back >= 0], back[back >= 0]
        young = place >= 0
        count[told[young]], count[told[found]] = place[young] & 255, back & 255
        ends = np.cumsum(count)
        ids = np.empty(ends[-1] if len(ends) else 0, np.uint32)
        for table, some, at in ((self.young, told[young], place[young]), (self.old, told[found], back)):
            ids[_spread((ends - count)[some], at & 255)] = table.ids[_spread(at >> 8, at & 255)]
        if len(found):
            self._add(keys[found], self.old.ids[_spread(back >> 8, back & 255)], back & 255)
        fresh = np.ones(len(texts), bool)
        fresh[told[young]] = fresh[told[found]] = False
        return ids, count, fresh

    def put(self, texts: pa.Array, ids: np.ndarray, count: np.ndarray) -> None:
        """Keep what ``get`` did not find."""
        keys, told = _keys(texts)
        told &= (count > 0) & (count <= MOST_IDS)
        told[told] = self.young.find(keys[told]) < 0  # told meanwhile, as a part of another
        self._add(keys[told], ids[np.repeat(told, count)], count[told])

    def _add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        most = self.most
        if self.young.used + len(keys) > most:
            self.young, self.old = _Table(), self.young
        self.young.add(keys[:most], ids[: count[:most].sum()], count[:most])


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, without added special tokens."""

    def __init__(self, path: str, slots: int | None = None):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.model = self.tokenizer.model
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.normalizer = self.tokenizer.normalizer
        pre = spec.get("pre_tokenizer") or {}
        split = next((p for p in pre.get("pretokenizers", []) if p["type"] == "Split"), None)
        #: Leading spaces belong to byte-level units; a splitting tokenizer drops them.
        self.spaced = split is None
        #: Bytes tell the pre-tokens of most units.
        self.by_bytes = self.spaced and self.normalizer is None
        pattern = split["pattern"]["Regex"] if split else r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.find = regex.compile(pattern).findall
        # The usual byte alphabet of byte-level models: printable Latin-1 stands for itself, the rest follows from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        told = {b: chr(256 + i) for i, b in enumerate(rest)}
        self.alphabet = "".join(told.get(b, chr(b)) for b in range(256))
        self.space = self.alphabet[32]
        self.known = spec.get("added_tokens") is not None and (
            split is not None or pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        )
        self.units, self.pieces, self.pieces_before = _Units(slots or SLOTS), {}, {}
        self.tokens = self.model.tokenize

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def cut(self, unit: str, prefix: str) -> str | list[str] | bytes | None:
        """The pre-token or those of a unit that follows a space (prefix " ") or starts the text (""); its ids where only the library tells them.

        None: they may depend on what stands beside it.
        """
        if _LETTERS(unit):
            told = prefix + unit if self.normalizer is None else unit.lower()
            if self.normalizer is None or told.isalpha():  # lower-casing may bring marks
                return told
        word, last = unit[:-1], unit[-1:]
        if last in _MARKS and _LETTERS(word):  # a word and a mark: two
            told = prefix + word if self.normalizer is None else word.lower()
            if self.normalizer is None or told.isalpha():
                return [told, last]
        if not unit or unit[0].isspace():
            if self.spaced and prefix:
                return None
            if not unit:
                return b""
        told = prefix + unit
        if not unit.isascii():
            if max(unit) >= "\u0250":  # rarer scripts: the character tables of two regex engines may differ
                return self.whole(told)
            if self.normalizer is not None:
                told = self.normalizer.normalize_str(told)
        elif self.normalizer is not None:
            told = told.lower()
        return self.find(told)

    def model_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens and how many each has. Their bytes are told as the model's letters at once: byte 255, which no text holds, parts them."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(pieces), SOME):
            some = "\udcff".join(pieces[at : at + SOME]).encode("utf-8", "surrogateescape")
            found = list(map(self.tokens, charmap_decode(some, "strict", self.alphabet)[0].split(self.alphabet[255])))
            counts.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.append(np.fromiter(map(_ID, chain.from_iterable(found)), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def make(self, units: list[str], prefix: str) -> list[bytes | None]:
        """Ids of units that are not kept; None as in ``cut``."""
        if self.normalizer is None:
            cuts = [prefix + u if u.isascii() and u.isalpha() else self.cut(u, prefix) for u in units]
        else:
            cuts = [u.lower() if u.isascii() and u.isalpha() else self.cut(u, prefix) for u in units]
        told = dict.fromkeys(chain.from_iterable(c for c in cuts if type(c) is list))
        # letters are kept where they are kept as units, which many of them are elsewhere
        skip, space = int(self.spaced), " " if self.spaced else ""
        words = [p for p in told if p.startswith(space) and _LETTERS(p[skip:])]
        others = list(told.keys() - set(words))
        stems = pa.array([p[skip:] for p in words], pa.string())
        ids, count, fresh = self.units.get(stems)
        told.update((p, x) for p, x, new in zip(words, self._parted(ids, count), fresh.tolist(), strict=True) if not new)
        told.update((p, self.pieces.get(p) or self.pieces_before.get(p)) for p in others)
        lone = dict.fromkeys(c for c in cuts if type(c) is str)
        once = [p for p in lone if told.get(p) is None] + [p for p, x in told.items() if x is None and p not in lone]
        told.update(zip(once, self._parted(*self.model_ids(once)), strict=True))
        made = [told[words[k]] for k in np.flatnonzero(fresh).tolist()]
        self.units.put(stems.filter(pa.array(fresh)), *self._joined(made))
        self._keep((p, told[p]) for p in others)
        return [told[c] if type(c) is str else b"".join(map(told.__getitem__, c)) if type(c) is list else c for c in cuts]

    def _keep(self, told: Iterable[tuple[str, bytes]]) -> None:
        """Keep pre-tokens that are no units, and their ids."""
        self.pieces.update((p, x) for p, x in told if len(p) <= WIDTH and len(x) <= 4 * MOST_IDS)
        if len(self.pieces) > PIECES:
            self.pieces, self.pieces_before = {}, self.pieces

    def make_plain(self, runs: pa.Array, per: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that follow a space and are not kept, from their pre-tokens (``per``: how many each has); how many each has."""
        heads = np.cumsum(per) - per
        leads = np.zeros(len(runs), bool)
        leads[heads] = True
        coded = runs.filter(pa.array(leads)).dictionary_encode()
        first, number = coded.dictionary, np.empty(len(runs), np.int64)
        number[heads] = coded.indices.to_numpy()
        coded = runs.filter(pa.array(~leads)).dictionary_encode()
        number[~leads] = coded.indices.to_numpy() + len(first)
        others = coded.dictionary.to_pylist()
        # the first ones are kept where they are kept as units, which many of them are elsewhere
        ids, count, fresh = self.units.get(first)
        kept = [self.pieces.get(p) or self.pieces_before.get(p) for p in others]
        lost = [p for p, x in zip(others, kept, strict=True) if x is None]
        told = first.filter(pa.array(fresh))
        made, n = self.model_ids([" " + p for p in told.to_pylist()])
        whole = np.zeros(len(first), bool)
        whole[number[heads[per == 1]]] = True  # kept with the units
        some = ~whole[fresh]
        self.units.put(told.filter(pa.array(some)), made[np.repeat(some, n)], n[some])
        more, m = self.model_ids(lost)
        parted = zip(lost, self._parted(more, m), strict=True)
        for _ in range(0, len(lost), SOME):
            self._keep(islice(parted, SOME))
        old, k = self._joined([x for x in kept if x is not None])
        # where the ids of each pre-token begin: of the first ones those kept, then made; of the others so too
        absent = np.concatenate((fresh, np.array([x is None for x in kept], bool)))
        count = np.concatenate((count, np.zeros(len(others), np.int64)))
        count[len(first) :][~absent[len(first) :]] = k
        count[absent] = np.concatenate((n, m))
        pool = np.concatenate((ids, old, made, more))
        where = np.empty(len(count), np.int64)
        ends = np.cumsum(np.concatenate((count[~absent], count[absent])))
        order = np.concatenate((np.flatnonzero(~absent), np.flatnonzero(absent)))
        where[order] = ends - count[order]
        each = count[number]
        return pool[_spread(where[number], each)], np.add.reduceat(each, heads)

    def told(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``inner`` of units that are not kept."""
        if self.by_bytes:
            runs, per, plain = _runs(units)
        else:
            plain = np.zeros(len(units), bool)
        rest, unsafe, count = np.flatnonzero(~plain), np.zeros(len(units), bool), np.zeros(len(units), np.int64)
        made = []
        for at in range(0, len(rest), SOME):
            made += self.make(units.take(pa.array(rest[at : at + SOME])).to_pylist(), " " if self.spaced else "")
        unsafe[rest] = [x is None for x in made]
        ids, count[rest] = self._joined([x or b"" for x in made])
        if not plain.any():
            return ids, count, unsafe
        more, count[plain] = self.make_plain(runs, per)
        first = np.empty(len(units), np.int64)
        first[rest] = np.cumsum(count[rest]) - count[rest]
        first[plain] = len(ids) + np.cumsum(count[plain]) - count[plain]
        return np.concatenate((ids, more))[_spread(first, count)], count, unsafe

    def inner(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different units that follow a space, or of any units where spaces are dropped; how many each has; which are None in ``cut``."""
        ids, count, fresh = self.units.get(units)
        places = np.flatnonzero(fresh)
        unsafe, parts, counts = np.zeros(len(units), bool), [ids], []
        # some thousands at a time: each holds its pre-tokens while it is told, in arrays where units are plain
        step = MANY * SOME if self.by_bytes else SOME
        for at in range(0, len(places), step):
            here = places[at : at + step]
            some = units.take(pa.array(here))
            new, n, unsafe[here] = self.told(some)
            self.units.put(some, new, n)
            parts.append(new)
            counts.append(n)
        if not counts:
            return ids, count, unsafe
        # first those found, then those made, dealt back to the order of the units
        made = np.concatenate(counts)
        first = np.cumsum(count) - count
        first[places] = len(ids) + np.cumsum(made) - made
        count[places] = made
        return np.concatenate(parts)[_spread(first, count)], count, unsafe

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) one after another, and how many each has."""
        collects = gc.isenabled()
        gc.disable()  # the model's tokens come in a list for each pre-token, none of them in a cycle
        try:
            return self._encode_all(texts)
        finally:
            if collects:
                gc.enable()

    def _encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if not self.known or not len(texts):
            return self._joined([self.whole(t) for t in texts.to_pylist()])
        odd = np.zeros(len(texts), bool)
        for t in self.added:
            odd |= pc.match_substring(texts, t).to_numpy(zero_copy_only=False)
        split = pc.split_pattern(texts, " ")
        starts, units = split.offsets.to_numpy(), split.values
        firsts = starts[:-1]
        numbered = units.dictionary_encode()
        number, told = numbered.indices.to_numpy().copy(), numbered.dictionary
        if self.spaced:  # the first unit of a text follows no space
            opening = units.take(pa.array(firsts)).dictionary_encode()
            number[firsts] = len(told)
            used = np.flatnonzero(np.bincount(number, minlength=len(told))[: len(told)])
            renamed = np.zeros(len(told) + 1, number.dtype)
            renamed[used] = np.arange(len(used))
            number, told = renamed[number], told.take(pa.array(used))
            number[firsts] = len(told) + opening.indices.to_numpy()
        ids, count, unsafe = self.inner(told)
        if self.spaced:
            first = opening.dictionary.to_pylist()
            made, n = self._joined(list(chain.from_iterable(self.make(first[at : at + SOME], "") for at in range(0, len(first), SOME))))
            ids, count, unsafe = np.concatenate((ids, made)), np.concatenate((count, n)), np.concatenate((unsafe, np.zeros(len(n), bool)))
        if unsafe.any():
            odd |= np.logical_or.reduceat(unsafe[number], firsts)
        # an array of 64-bit offsets: the ids of one long text may take more than 2 GB
        offsets = np.zeros(len(count) + 1, np.int64)
        np.cumsum(4 * count, out=offsets[1:])
        flat = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])
        flat = flat.take(pa.array(number))
        ends = np.frombuffer(flat.buffers()[1], np.int64, len(number) + 1)[starts] // 4
        ids = np.frombuffer(flat.buffers()[2], "<u4", ends[-1]) if ends[-1] else np.zeros(0, "<u4")
        if not odd.any():
            return ids, np.diff(ends)
        return self._joined([self.whole(texts[k].as_py()) if odd[k] else ids[a:b].tobytes() for k, (a, b) in enumerate(pairwise(ends.tolist()))])

    @staticmethod
    def _joined(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded], np.int64)

    @staticmethod
    def _parted(ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """The reverse of ``_joined``."""
        raw = ids.tobytes()
        return [raw[a:b] for a, b in pairwise(accumulate((4 * count).tolist(), initial=0))]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, slots: int = SLOTS) -> Encoder:
    """One encoder for each file, size of its tables and worker process."""
    if (path, slots) not in _ENCODERS:
        _ENCODERS[path, slots] = Encoder(path, slots)
    return _ENCODERS[path, slots]
