"""MPEG streams around texts that look like parts of one."""

from hashlib import sha256

import pytest

from plexwell.llm import mpeg
from plexwell.llm.common import Scratch

from .test_operators import frame, prose


def stored(text):
    media = mpeg.build(mpeg.padded(text))
    return media, mpeg.extract(media, mpeg.parse(media))


@pytest.mark.parametrize("mark", [b"TAG", b"ID3", b"Xing", b"Info", b"TAG" + b"x" * 125, b"ID3\x04\0\0\0\0\0\x7f"])
def test_texts_that_look_like_tags(mark):
    for at in range(0, 3000 - len(mark)):
        text = b"w" * at + mark + b"w" * (3000 - at - len(mark))
        assert stored(text)[1] == mpeg.padded(text), at


def test_texts_of_every_size():
    for n in range(3000):
        text = (b"TAG" * 1000)[:n]
        media, payload = stored(text)
        assert payload == mpeg.padded(text)
        # frames by their lengths alone: 1044 bytes hold 1006, and the last is the shortest that does
        at, offsets = mpeg.id3v2(media)[0], []
        while at < len(media):
            offsets.append(at)
            at += mpeg.header(media[at : at + 4]).length
        assert at == len(media) and offsets[1:] == mpeg.parse(media).offsets


def test_tag_after_the_frames_is_one():
    media = mpeg.build(mpeg.padded(b"abc" * 900))
    tag = b"TAG" + b"t" * 125
    p, q, r = mpeg.parse(media), mpeg.parse(media + tag), mpeg.parse(media + b"junk" + tag)
    assert p.offsets == q.offsets and q.skipped == 0 and r.skipped == 4
    for damaged in (media[:-1], media + b"x", media.replace(b"Xing", b"Xinh")):
        with pytest.raises(ValueError):
            mpeg.extract(damaged, mpeg.parse(damaged))


def test_stored_columns(spark):
    rows = [(k, prose(k, k * 40)) for k in range(12)] + [(20, None), (21, "x" * 3_000_000), (22, "TAG" * 40000)]
    for r in mpeg.read(mpeg.store(frame(spark, rows), Scratch(spark, "t"))).collect():
        media, payload = stored((dict(rows)[r["doc_id"]] or "").encode())
        p = mpeg.parse(media)
        assert (r["media_bytes"], r["media_sha256"], r["payload_sha256"]) == (len(media), sha256(media).hexdigest(), sha256(payload).hexdigest())
        assert r["frame_offsets"] == p.offsets and r["duration_us"] == len(p.offsets) * 1152 * 1_000_000 // 44100
        assert f"frames={len(p.offsets)};" in r["feature"] and "crc_bad=0" in r["feature"]
