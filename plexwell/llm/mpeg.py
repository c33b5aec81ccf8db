"""MPEG audio columns: frames found by resynchronising headers, tags and seek tables parsed, checksums verified.

``build`` stores bytes losslessly in an MPEG-1 Layer III stream: the ancillary bytes after the (empty) main data of each
frame hold them, an ID3v2 tag tells how many there are, a Xing frame has frame and byte counts and a table of contents.
Players hear silence. ``parse`` reads any MPEG 1, 2 or 2.5 stream of Layers I to III: damaged or foreign bytes between frames
are skipped, a frame counts if a header that agrees with it, a tag or the end follows, or if its checksum is right.

A null text is empty; an empty text gives 64 zero bytes. A text may hold what looks like tags or tables (``TAG``, ``ID3``,
``Xing``): inside a frame it is payload, and UTF-8 has no byte 0xFF to be taken for a frame's start. Equal texts give equal values. Rows with equal or null doc_id
are handled each for themselves. An empty table gives no rows. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Scratch, cut_batches, text_bytes

# Fixed values of the MPEG audio standards (kbit/s by index, free format and the forbidden index left out).
BITRATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}
TOC = 100


@dataclass(frozen=True)
class Header:
    version: int  # 3: MPEG 1, 2: MPEG 2, 0: MPEG 2.5
    layer: int
    protected: bool
    bitrate: int
    rate: int
    channels: int
    joint: int  # the mode extension in joint stereo, else -1
    length: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of Layer III side information."""
        mono = self.channels == 1
        return (17 if mono else 32) if self.version == 3 else (9 if mono else 17)


@lru_cache(4096)
def header(word: bytes) -> Header | None:
    """The header in four bytes, or None if they are none (free format has no length and counts as none)."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    bitrate, rate = word[2] >> 4, word[2] >> 2 & 3
    if version == 1 or layer == 4 or bitrate in (0, 15) or rate == 3 or word[3] & 3 == 2:
        return None
    family = 1 if version == 3 else 2
    kbps, hz, pad = BITRATES[family, layer][bitrate - 1], RATES[version][rate], word[2] >> 1 & 1
    samples = SAMPLES[family, layer]
    length = (12 * kbps * 1000 // hz + pad) * 4 if layer == 1 else samples // 8 * kbps * 1000 // hz + pad
    mode = word[3] >> 6
    return Header(version, layer, not word[1] & 1, kbps, hz, 1 if mode == 3 else 2, word[3] >> 4 & 3 if mode == 1 else -1, length, samples)


def crc16(data: bytes) -> int:
    """The checksum of protected frames: polynomial 0x8005, from 0xFFFF."""
    crc = 0xFFFF
    for b in data:
        crc ^= b << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(65536)
def checksum(covered: bytes) -> int:
    return crc16(covered)


def crc_state(data: bytes, at: int, h: Header) -> int:
    """1: the checksum is right, 0: wrong, -1: none, or one over a part whose length only decoding tells (Layer II)."""
    if not h.protected or h.layer == 2:
        return -1
    if h.layer == 3:
        covered = data[at + 6 : at + 6 + h.side]
    else:  # bit allocations: four bits a subband and channel, once for both above the bound of joint stereo
        bound = 32 if h.joint < 0 else 4 * (h.joint + 1)
        covered = data[at + 6 : at + 6 + (4 * (bound * h.channels + (32 - bound)) if h.channels == 2 else 128) // 8]
    return int(checksum(data[at + 2 : at + 4] + covered) == int.from_bytes(data[at + 4 : at + 6], "big"))


def _syncsafe(raw: bytes) -> int:
    return raw[0] << 21 | raw[1] << 14 | raw[2] << 7 | raw[3]


def id3v2(data: bytes) -> tuple[int, dict[str, str]]:
    """Bytes of the tag at the start (0: none) and its text frames; user texts as ``TXXX:name``."""
    if len(data) < 10 or data[:3] != b"ID3" or max(data[6:10]) > 127:
        return 0, {}
    major, end = data[3], 10 + _syncsafe(data[6:10])
    tags, at = {}, 10
    if data[5] & 0x40 and len(data) >= 14:
        at += _syncsafe(data[10:14]) if major == 4 else 4 + int.from_bytes(data[10:14], "big")
    while at + 10 <= min(end, len(data)) and data[at] and major >= 3:
        name, raw = data[at : at + 4], data[at + 4 : at + 8]
        size = _syncsafe(raw) if major == 4 else int.from_bytes(raw, "big")
        body = data[at + 10 : min(at + 10 + size, end)]
        at += 10 + size
        if name[:1] == b"T" and body:
            code = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
            text = body[1:].decode(code, "replace").rstrip("\0")
            if name == b"TXXX":
                label, _, text = text.partition("\0")
                tags[f"TXXX:{label}"] = text
            else:
                tags[name.decode("latin-1")] = text
    return end + (10 if data[5] & 0x10 else 0), tags


@dataclass
class Parsed:
    offsets: list[int] = field(default_factory=list)  # of audio frames (the table frame is none)
    bodies: list[tuple[int, int]] = field(default_factory=list)  # what follows header, checksum and side information
    rate: int = 0
    samples: int = 0
    good: int = 0
    bad: int = 0
    skipped: int = 0  # bytes that belong to no frame or tag
    tags: dict[str, str] = field(default_factory=dict)
    vbr_frames: int | None = None
    vbr_bytes: int | None = None
    toc: bytes | None = None

    @property
    def duration_us(self) -> int:
        """Exact to the rounding of the last microsecond."""
        return self.samples * 1_000_000 // self.rate if self.rate else 0


def parse(data: bytes) -> Parsed:
    out = Parsed()
    at, out.tags = id3v2(data)
    end, first = len(data), True
    # an ID3v1 tag stands where the frames end; inside a frame the same three letters are the frame's own bytes
    tag = end - 128 if end - at >= 128 and data[end - 128 : end - 125] == b"TAG" else end
    while at < end and at != tag:
        h = header(data[at : at + 4])
        after = at + h.length if h else 0
        follows = h and (after in (end, tag) or after < end and (n := header(data[after : after + 4])) is not None and (n.version, n.layer, n.rate) == (h.version, h.layer, h.rate))
        state = crc_state(data, at, h) if h and after <= end else -1
        if not (follows or state == 1):
            nxt = data.find(b"\xff", at + 1, end)
            nxt = end if nxt < 0 else nxt
            if at < tag < nxt:
                nxt = tag
            out.skipped += nxt - at
            at = nxt
            continue
        out.good += state == 1
        out.bad += state == 0
        body = at + 4 + 2 * h.protected + (h.side if h.layer == 3 else 0)
        if first and h.layer == 3 and data[body : body + 4] in (b"Xing", b"Info"):
            flags, p = int.from_bytes(data[body + 4 : body + 8], "big"), body + 8
            if flags & 1:
                out.vbr_frames = int.from_bytes(data[p : p + 4], "big")
                p += 4
            if flags & 2:
                out.vbr_bytes = int.from_bytes(data[p : p + 4], "big")
                p += 4
            if flags & 4:
                out.toc = data[p : p + TOC]
        else:
            out.offsets.append(at)
            out.bodies.append((body, after))
            out.samples += h.samples
            out.rate = h.rate
        first = False
        at = after
    return out


def _front(index: int) -> bytes:
    """Header, checksum and empty side information of a protected stereo Layer III frame at 44.1 kHz."""
    word = bytes((0xFF, 0xFA, (index << 4), 0x00))
    side = bytes(32)
    return word + struct.pack(">H", crc16(word[2:4] + side)) + side


_FRONTS = {index: _front(index) for index in range(1, 15)}
_ROOM = {index: header(front[:4]).length - len(front) for index, front in _FRONTS.items()}


def build(payload: bytes) -> bytes:
    """A stream whose ancillary bytes are ``payload``: frames of the largest size, then the least that holds the rest."""
    most = max(_ROOM)
    room = _ROOM[most]
    cuts = [payload[i : i + room] for i in range(0, len(payload), room)]
    frames = [_FRONTS[most] + c for c in cuts[:-1] or []]
    if cuts:
        index = min(i for i, r in _ROOM.items() if r >= len(cuts[-1]))
        frames.append((_FRONTS[index] + cuts[-1]).ljust(_ROOM[index] + len(_FRONTS[index]), b"\0"))
    sizes = [len(f) for f in frames]
    text = b"\x03payload_bytes\0" + str(len(payload)).encode()
    tag = b"TXXX" + _to_syncsafe(len(text)) + b"\0\0" + text
    tag = b"ID3\x04\0\0" + _to_syncsafe(len(tag)) + tag
    index = min(i for i, r in _ROOM.items() if r >= 16 + TOC)
    total = sum(sizes) + _ROOM[index] + len(_FRONTS[index])
    starts = [0, *accumulate(sizes)][:-1]
    table = b"Xing" + struct.pack(">III", 7, len(sizes), total) + contents([total - sum(sizes) + s for s in starts], total)
    return tag + (_FRONTS[index] + table).ljust(_ROOM[index] + len(_FRONTS[index]), b"\0") + b"".join(frames)


def contents(starts: list[int], total: int) -> bytes:
    """The table of contents: the 256th of the stream at which each hundredth of the play time starts."""
    return bytes(min(255, starts[k * len(starts) // TOC] * 256 // total) if starts else 0 for k in range(TOC))


def _to_syncsafe(n: int) -> bytes:
    return bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127))


def extract(media: bytes, parsed: Parsed) -> bytes:
    """The payload of a stream of ``build``; ValueError if it isn't whole."""
    size = int(parsed.tags.get("TXXX:payload_bytes", -1))
    payload = b"".join(media[a:b] for a, b in parsed.bodies)[: max(size, 0)]
    first = id3v2(media)[0]  # the table frame comes right after the tag and counts itself
    table = contents([o - first for o in parsed.offsets], len(media) - first)
    told = (parsed.vbr_frames, parsed.vbr_bytes, parsed.toc) == (len(parsed.offsets), len(media) - first, table)
    if len(payload) != size or parsed.bad or parsed.skipped or not told:
        raise ValueError("the stored stream is damaged")
    return payload


def padded(text: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return text.ljust(max(64, -(-len(text) // 64) * 64), b"\0")


def _store(batches):
    for batch in cut_batches(batches, 1):
        texts = batch.column(1).to_pylist()
        media = [build(padded(t)) for t in texts]
        yield pa.record_batch([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])


def store(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Write doc_id, n_bytes and media of every text, and read them back."""
    return scratch.table(text_bytes(docs, "doc_id").mapInArrow(_store, "doc_id long, n_bytes long, media binary"), "media")


_COLUMNS = (
    ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()),
    ("media_sha256", pa.string()), ("feature", pa.string()), ("duration_us", pa.int64()), ("frame_offsets", pa.list_(pa.int64())),
)


def _read(batches):
    for batch in cut_batches(batches, 2):
        rows = []
        for n, media in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            p = parse(media)
            payload = extract(media, p)
            offsets = zlib.crc32(b"".join(o.to_bytes(8, "little") for o in p.offsets))
            feature = f"mpeg1-layer3;rate={p.rate};frames={len(p.offsets)};samples={p.samples};us={p.duration_us};crc_ok={p.good};crc_bad={p.bad};seek={offsets:08x}"
            rows.append((n, len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), sha256(media).hexdigest(), feature, p.duration_us, p.offsets))
        cols = list(zip(*rows, strict=True)) or [[] for _ in _COLUMNS]
        yield pa.record_batch([batch.column(0), *(pa.array(list(c), k) for c, (_, k) in zip(cols, _COLUMNS, strict=True))], names=["doc_id", *(n for n, _ in _COLUMNS)])


def read(stored: DataFrame) -> DataFrame:
    """Features of stored streams, their payload taken from the stored bytes."""
    return stored.mapInArrow(
        _read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_us long, frame_offsets array<long>"
    )


def op6_mpeg(spark, sf_dir: str) -> DataFrame:
    return read(store(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "mpeg")))
