"""Each training-data operator against brute force, with nulls, empty and repeated rows, long texts and clashing columns."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from plexwell.llm import decontaminate, interpolation, license_scan, line_dedup, mpeg, packing, quality, simhash, style_tree, token_store
from plexwell.llm.common import Scratch
from plexwell.llm.tokens import Encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, part int, hash string, row long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


LINE = "a line that many documents share, long enough to count"


def texts():
    out = [None, "", " ", "\n\n", "one", "Two words", prose(1, 60), prose(1, 60), prose(2, 3000), f"{LINE}\nown {prose(3, 8)}", "x<|endoftext|>y  z", "日本語 é̈ ß İ", "a\x00b\x1cc"]
    out += [f"{prose(k, 6)}\n  {LINE.upper()}\t\nend" for k in range(10, 16)]
    out += [prose(40, 50) + f" tail{k}" for k in range(4)]
    return out


def frame(spark, rows=None):
    rows = list(enumerate(texts())) if rows is None else rows
    rows = [(i, t, "en", "s", len(t or ""), 1, "h", 7) for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA)


def test_encoder_equals_library():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = Encoder(public_tokenizers.path(name))
        for t in [*texts(), "  a  b", " \n x", "it's we'll\t12 345", "ŉ İ. ſ, ª º", "trail ", "ΑΣ Σ ﬁ"]:
            assert e.encode(t or "") == e.whole(t or ""), t


def expected_ids(name, rows):
    e = Encoder(public_tokenizers.path(name))
    return [(i, e.whole(t or "") + bytes(4)) for i, t in rows]


def test_token_store(spark):
    docs = frame(spark, [*enumerate(texts()), (3, "again"), (None, "no id")])
    store = token_store.write_store(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in token_store.read_back(store).collect()}
    told = expected_ids("byte_bpe_50k.json", [(None, "no id"), *enumerate(texts())])
    assert len(got) == len(texts()) + 2
    assert Counter((i, n, c) for (i, _), (n, c) in got.items()) == Counter([(i, len(b) // 4, zlib.crc32(b)) for i, b in [*told, *expected_ids("byte_bpe_50k.json", [(3, "again")])]])
    at = 0
    for (_, start), (n, _) in sorted(got.items(), key=lambda x: x[0][1]):
        assert start == at
        at += n
    ids = {(r["doc_id"], r["start"]): r["ids"] for r in token_store.read_ids(store).collect()}
    assert all(zlib.crc32(np.array(ids[k], "<u4").tobytes()) == c for k, (_, c) in got.items())
    assert store.chunks.count() == store.chunks.select("digest").distinct().count()
    assert token_store.read_back(token_store.write_store(spark, frame(spark, []), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_chunks_follow_content():
    ids = np.random.default_rng(5).integers(0, 50000, 6000).astype("<u4")
    a, b = token_store.boundaries(ids, [6000])[0], token_store.boundaries(np.concatenate((ids[:7], ids)), [6007])[0]
    ends = lambda s, off: {x - off for x in np.cumsum(s).tolist()}
    assert len(ends(a, 0) & ends(b, 7)) > len(a) * 0.7 and sum(a) == 6000 and max(a) <= token_store.MAX_CHUNK
    assert token_store.crc_shift(0) == 1 << 31


def test_packing(spark):
    rows = [*enumerate(texts()), (None, prose(9, 5000)), (6, "same id")]
    got = packing.pack(spark, frame(spark, rows), public_tokenizers.path("word_bpe_49k.json"), capacity=128).collect()
    want = Counter()
    for i, b in expected_ids("word_bpe_49k.json", rows):
        for k, at in enumerate(range(0, len(b), 512)):
            want[i, k, at // 4, len(b[at : at + 512]) // 4, zlib.crc32(b[at : at + 512])] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= 128
    assert len(places) <= -(-sum(r["length"] for r in got) // 128) + 2
    assert packing.pack(spark, frame(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed):
    counts = np.bincount(np.random.default_rng(seed).integers(1, 65, 400), minlength=65)
    patterns = packing.plan(counts, 64)
    used = Counter()
    for p, times in patterns:
        assert sum(n * k for n, k in p.items()) <= 64
        for n, k in p.items():
            used[n] += k * times
    assert all(used[n] == c for n, c in enumerate(counts.tolist()))
    gaps: list[int] = []  # of best-fit decreasing over single pieces
    for n in range(64, 0, -1):
        for _ in range(counts[n]):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else 64) - n)
    assert sum(t for _, t in patterns) <= len(gaps) + 1


def brute_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip("\t\n\x0b\x0c\r "))
    docs = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                docs.setdefault(key(x), set()).add(i)
    hot = {k: max(x for x in v if x is not None) for k, v in docs.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in hot or hot[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup(spark):
    rows = [*enumerate(texts()), (None, LINE), (15, f"{LINE}\n{LINE}\nsame id"), (12, "x"), (2, f"{LINE}\n{prose(7, 20)}\n{LINE}")]
    got = line_dedup.dedup_lines(frame(spark, rows), keep=("lang", "hash")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    assert Counter(map(tuple, got.collect())) == brute_lines(rows)
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0


def test_decontamination(spark):
    item = prose(50, 30)
    words = item.split()
    bench = [(1, item), (2, prose(50, 30) + " more"), (10, "Short, ITEM!"), (11, None), (12, ""), (None, item), (2, "second row"), (13, "x")]
    rows = [*enumerate(texts()), (30, " ".join(words[3:13]).upper()), (31, "! ".join(words[:40])), (32, "so short item here"), (33, " ".join(words[:9])), (None, item), (30, "x y")]
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in bench], "item_id long, text string, hits string")
    want = Counter(decontaminate.brute_force(rows, bench))
    for size in (decontaminate.BLOCK_BYTES, 60):
        found = decontaminate.find_contamination(frame(spark, rows), benchmark, keep=("source",), block_bytes=size)
        got = found.select("doc_id", "n_words", decontaminate.n_hit(), F.size("items"), F.sha2(F.array_join("items", ","), 256), decontaminate.n_hit() > 0)
        assert Counter(map(tuple, got.collect())) == want
    cleaned = {r["doc_id"]: r["text"] for r in decontaminate.remove_contamination(frame(spark, [(1, f"before, {item} after."), (2, item), (3, "clean"), (4, None)]), benchmark.where("item_id = 1"), max_coverage=0.95).collect()}
    assert cleaned == {1: "before,  after.", 3: "clean", 4: ""}
    assert decontaminate.find_contamination(frame(spark), benchmark.limit(0)).where(decontaminate.n_hit() > 0).count() == 0
    assert decontaminate.find_contamination(frame(spark, []), benchmark).count() == 0


def test_automaton_on_random_words():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        make = lambda n, rng=rng: " ".join(rng.choice(list("abc"), n))
        bench = [(k, make(int(rng.integers(0, 12)))) for k in range(6)]
        text = make(60)
        auto = decontaminate.Automaton([(str(i), t.encode().split()) for i, t in bench], 4)
        ids = np.array([auto.vocab.get(w, -1) for w in text.encode().split()], np.int64)
        hits, items = [], set()
        for a, b in auto.ranges(ids) if auto.vocab else []:
            auto.search(ids[a:b].tolist(), a, hits, items)
        want = decontaminate.brute_force([(0, text)], bench, 4)[0]
        assert sum(b - a for a, b in decontaminate._merge(hits)) == want[2] and len(items) == want[3]


def brute_components(codes, limit=3):
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (int(codes[i]) ^ int(codes[j])).bit_count() <= limit and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("seed", range(6))
def test_gray_index(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 8, dtype=np.uint64)
    codes = {int(b) ^ sum(1 << int(k) for k in rng.integers(0, 64, rng.integers(0, 7))) for b in base for _ in range(40)}
    codes |= {int(base[0]) ^ k for k in range(8)}
    codes = np.array(sorted(codes), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    got = simhash.GrayIndex(codes).forest(3).tolist()
    want = brute_components(codes)
    assert len(set(zip(got, want, strict=True))) == len(set(want)) == len(set(got))


def test_simhash(spark, monkeypatch):
    rows = [*enumerate(texts()), (None, "no id"), (40, None), (5, prose(40, 50) + " tail9"), (41, prose(8, 200)), (42, prose(8, 200) + " end")]
    codes = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    want = brute_components(codes)
    least = {}
    for (i, _), c in zip(rows, want, strict=True):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    told = Counter((i, f"{k:016x}", least[c]) for (i, _), k, c in zip(rows, codes, want, strict=True))
    for group in (simhash.GROUP, 3):  # 3: groups are dealt out as pairs of parts
        monkeypatch.setattr(simhash, "GROUP", group)
        got = simhash.near_duplicates(frame(spark, rows), keep=("part",)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
        assert Counter(map(tuple, got.collect())) == told
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_fingerprint_is_sparks_hash(spark):
    t = "The Quick brown\tfox jumps over"
    w = t.lower().split()
    rows = spark.createDataFrame([(" ".join(w[i : i + 3]),) for i in range(len(w) - 2)], "s string").select(F.xxhash64("s")).collect()
    hs = [r[0] & (1 << 64) - 1 for r in rows]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))
    assert simhash.fingerprint(t.encode()) == want


def test_mpeg(spark):
    rows = [*enumerate(texts()), (None, "x"), (1, "")]
    got = mpeg.read(mpeg.store(frame(spark, rows), Scratch(spark, "t"))).collect()
    want = Counter()
    for i, t in rows:
        raw = (t or "").encode()
        p = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        want[i, len(raw), len(p), sha256(p).hexdigest(), zlib.crc32(p[-64:])] += 1
    assert want == Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got)
    assert len({r["feature"] for r in got if r["n_bytes"] == 0}) == 1
    assert mpeg.read(mpeg.store(frame(spark, []), Scratch(spark, "t"))).count() == 0


def test_mpeg_resynchronises():
    payload = bytes(np.random.default_rng(1).integers(0, 256, 64 * 100, dtype=np.uint8))
    media = mpeg.build(payload)
    p = mpeg.parse(media)
    assert mpeg.extract(media, p) == payload and p.bad == p.skipped == 0 and p.good == len(p.offsets) + 1
    assert p.vbr_bytes == len(media) - p.offsets[0] + (p.offsets[0] - mpeg.id3v2(media)[0]) and len(p.toc) == 100
    assert p.duration_us == len(p.offsets) * 1152 * 1_000_000 // 44100
    second = p.offsets[1]
    broken = media[:second] + b"\xff\xfbjunk\xff" * 3 + media[second:]
    q = mpeg.parse(broken)
    assert q.skipped == 21 and len(q.offsets) >= len(p.offsets) - 1
    flipped = bytearray(media)
    flipped[second + 10] ^= 1
    assert mpeg.parse(bytes(flipped)).bad == 1
    with pytest.raises(ValueError):
        mpeg.extract(bytes(flipped), mpeg.parse(bytes(flipped)))
    assert mpeg.parse(b"").offsets == [] and mpeg.parse(b"\xff" * 50).offsets == []
    assert mpeg.header(b"\xff\xfb\x90\x64").length == 417 and mpeg.header(b"\xff\xfb\x90\x64").bitrate == 128


def test_quality(spark):
    good, bad = [(k, prose(k, 80)) for k in range(100, 220)], [(k, prose(k, 80).upper().replace(" ", "!! ")) for k in range(220, 300)]
    rows = [*good, *bad, *enumerate(texts()), (None, "x"), (100, prose(1, 5))]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(150, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(frame(spark, rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    truth = {i: 1 for i, _ in good} | {i: 0 for i, _ in bad}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert {r["score"] for r in quality.score(frame(spark), labels.limit(0)).collect()} == {0.5}
    kept = quality.score(frame(spark, rows), labels, keep=("text", "part"))
    assert Counter((r["doc_id"], r["score"]) for r in kept.collect()) == Counter((r["doc_id"], r["score"]) for r in got)
    assert quality.score(frame(spark, []), labels).count() == 0


def test_pair_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in {p[:2] for p in model.pairs} and ((model.score(x) >= 0.5) == y).mean() > 0.95


PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a>b">Menu</a></li></ul></nav><!-- <p>no</p> -->'
    '<div class="ad">Buy</div><article><h1>Title &amp;amp; more</h1><p><b>One <i>two</i><br>\n three<p>Four&nbsp;x</p><div class="comments"><p>me too</p></div></article>'
    '<div id="cookie-notice">ok?</div><form><p>search</p></form><footer>&copy; me</footer></body></html>'
)


def test_main_text():
    assert style_tree.main_text(PAGE) == "Title &amp; more\n\nOne two three\n\nFour x"
    assert style_tree.main_text("") == "" and style_tree.main_text("plain &lt; text") == "plain < text"
    assert style_tree.main_text("<p>a</p><p>  b\n c</p><aside>d</aside>") == "a\n\nb c"
    assert style_tree.site_of("HTTP://u:p@Host.Example:80/x?y") == "host.example" and style_tree.site_of(None) == ""


def test_site_judges_unmarked_pages(spark):
    body = "<html><body><div class='top'><p>Same words on each page</p></div><div class='text'><p>{}</p><p>{}</p></div></body></html>"
    rows = [(k, f"https://h.example/{k}", body.format(prose(k, 12), prose(k + 50, 9)), 1) for k in range(8)]
    rows += [(20, None, None, 1), (21, "no host", "", 1), (22, "https://o.example/", PAGE, 1), (22, "https://o.example/", PAGE, 1)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string, low int")).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 12 and by[20] == by[21] == "" and by[22].startswith("Title")
    assert all(by[k] == f"{prose(k, 12)}\n\n{prose(k + 50, 9)}" for k in range(8))
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    copies = spark.createDataFrame([(k, f"https://c.example/{k}", PAGE) for k in range(30)], "page_id long, url string, html string")
    assert {r["text"] for r in style_tree.extract(copies).collect()} == {style_tree.main_text(PAGE)}
    assert style_tree.extract(copies.limit(0)).count() == 0


@pytest.mark.parametrize("order", [2, 3])
def test_interpolation(spark, monkeypatch, order):
    rows = [*enumerate(texts()), *((k, prose(k, 30)) for k in range(50, 120)), (None, "alpha beta"), (3, "alpha beta")]
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + ["</s>"]
    crc = lambda i: zlib.crc32(b"" if i is None else str(i).encode())
    train = [split(t) for i, t in rows if crc(i) % 7 != 2]
    kept = [split(t) for i, t in rows if crc(i) % 7 != 2 and crc(i) // 7 % 10]
    dev = [split(t) for i, t in rows if crc(i) % 7 != 2 and crc(i) // 7 % 10 == 0]

    def grams(docs):
        c, ctx = Counter(), Counter()
        for d in docs:
            d = ["<s>"] * (order - 1) + d
            for i in range(order - 1, len(d)):
                for k in range(order):
                    c[tuple(d[i - k : i + 1])] += 1
                    ctx[tuple(d[i - k : i])] += 1
        return c, ctx

    def estimates(d, i, c, ctx):
        d = ["<s>"] * (order - 1) + d
        i += order - 1
        n, v = ctx[()], len({g for g in c if len(g) == 1})
        p = [1 / (v + 1), c[(d[i],)] / max(n, 1)] + [c[tuple(d[i - k : i + 1])] / max(ctx[tuple(d[i - k : i])], 1) for k in range(1, order)]
        return p, min(int(ctx[tuple(d[i - order + 1 : i])]).bit_length(), interpolation.CONTEXT_BUCKETS - 1)

    c, ctx = grams(kept)
    seen = [estimates(d, i, c, ctx) for d in dev for i in range(len(d))]
    cells = Counter((b, tuple(interpolation._cells(np.array(p[1:])).tolist())) for p, b in seen)
    weights = interpolation.learn(sorted((b, list(p), n) for (b, p), n in cells.items()), order, 1 / (len({g for g in c if len(g) == 1}) + 1))
    c, ctx = grams(train)
    n, v = ctx[()], len({g for g in c if len(g) == 1})
    want = []
    for i, t in rows:
        d = split(t)
        s = sum(np.log10(np.dot(*(lambda pb: (pb[0], weights[pb[1]]))(estimates(d, k, c, ctx)))) for k in range(len(d)))
        want.append((-1 if i is None else i, crc(i) % 7 == 2, len(d), sum(c[(w,)] > 0 for w in d), n, round(sum(np.log10((c[(w,)] + 1) / (n + v + 1)) for w in d), 5), round(s, 5)))
    monkeypatch.setattr(interpolation, "BUCKET_ENTRIES", 200)
    got = [(-1 if r[0] is None else r[0], *r[1:5], round(r[5], 5), round(r[6], 5)) for r in interpolation.score(frame(spark, rows), order).collect()]
    assert sorted(got) == sorted(want)
    assert interpolation.score(frame(spark, []), order).count() == 0


def test_deltas():
    for n in (1, 2, 500):
        h = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        assert (interpolation._hashes(interpolation._deltas(h)) == h).all()


def test_license_scan(spark):
    rows = [*enumerate(texts()), (30, "x\nReleased under the MIT license"), (31, "  * LICENSED under the Apache License, version 2.0!\nlicense"), (32, license_scan.TEMPLATES["GPL-3.0-notice"].replace(" you ", " thou ")), (30, "x\nReleased under the MIT license")]

    def grams(t):
        w = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", t.lower()).split(" ")
        w = [x for x in w if x]
        return set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} if w else set()

    want = set()
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            a = grams(line)
            for name, notice in license_scan.TEMPLATES.items():
                b = grams(notice)
                if a and (dice := 2 * len(a & b) / (len(a) + len(b))) >= 0.8:
                    want.add((i, k, name, round(dice, 6)))
    assert {tuple(r) for r in license_scan.scan(frame(spark, rows)).collect()} == want and len(want) >= 3
    assert license_scan.scan(frame(spark, [])).count() == 0


def test_license_runs(spark, tmp_path):
    """Notices over several lines, beside other words, and whole texts, against every run of words."""
    grant, gpl = license_scan.TEMPLATES["MIT-grant"].split(), license_scan.TEMPLATES["GPL-3.0-notice"].split()
    wrap = lambda ws, n, lead="": "\n".join(lead + " ".join(ws[k : k + n]) for k in range(0, len(ws), n))
    rows = [*enumerate(texts()), (50, "Title\n" + wrap(grant, 12, " * ")), (51, "Copyright 2020 Foo. Released under the MIT License."), (52, wrap(gpl, 14, "# ")), (None, f"{prose(60, 40)} This work is licensed\nunder CC BY-NC 4.0. {prose(61, 40)}")]
    rows += [(53, "a\n" + wrap(license_scan.TEXTS["BSD-3-Clause-text"].split(), 11)), (54, "Released under the\nMIT License. Released under the MIT License.\nReleased under the MIT License."), (51, "Released under\nthe MIT License."), (55, "licensed the software under permission")]
    frame(spark, rows + [rows[-2]]).write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["license"]): (r["first_line"], r["n_lines"], r["dice"]) for r in license_scan.op2_license_scan(spark, str(tmp_path)).collect()}
    normal = lambda t: re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", t.lower()).split()
    want = {}
    for name, notice in (license_scan.TEMPLATES | license_scan.TEXTS).items():
        ws = normal(notice)
        grams = set(zip(ws, ws[1:], strict=False))
        for i, t in rows:
            text = normal(t or "")
            pairs = list(zip(text, text[1:], strict=False))
            for a in range(len(pairs)):
                if pairs[a] in grams:
                    for b in range(a + 1, min(len(pairs), a + int(1.5 * len(grams) + 1e-9)) + 1):
                        run = pairs[a:b]
                        own = set(run) & grams
                        dice = 2 * len(own) / (sum(g not in grams for g in run) + len(own) + len(grams))
                        if round(dice, 6) >= 0.8:
                            want[i, name] = max(want.get((i, name), 0), round(dice, 6))
    assert {k: v[2] for k, v in got.items()} == want
    assert got[50, "MIT-grant"] == (1, 1, 1.0) and got[51, "MIT"] == (0, 2, 1.0) and got[52, "GPL-3.0-notice"] == (0, 1, 1.0) and got[None, "CC-BY-NC-4.0"] == (0, 1, 1.0)
    assert got[53, "BSD-3-Clause-text"] == (1, 1, 1.0) and got[54, "MIT"] == (0, 3, 1.0)
    assert license_scan.scan_text(frame(spark, [])).count() == 0
