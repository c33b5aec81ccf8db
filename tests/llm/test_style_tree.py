"""Site style trees: markup as browsers read it, importance against a plain recomputation, copies, and hostile pages."""

import math
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from plexwell.llm import style_tree
from plexwell.llm.style_tree import main_text

from .test_operators import PAGE, prose


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article><p title="a hidden gem">kept text</p><p>b</p></article>', "kept text\n\nb"),
        ('<article><p aria-hidden="false">x</p><p data-role="banner">y</p><p class="notice">body</p></article>', "x\n\ny\n\nbody"),
        ('<article><p>a</p><p hidden>no</p><p aria-hidden="true">no</p><div class="comments"><p>no</p></div></article>', "a"),
        ('<body id="page" class="has-sidebar header-fixed"><div class="content-sidebar-wrap"><main><h1>T</h1><p>x</p></main><div class="sidebar">no</div></div></body>', "T\n\nx"),
        ('<article><p>x</p></article><div class="comments"><article class="comment"><p>no</p></article></div>', "x"),
        ("<article><header><h1>T</h1></header><p>x<aside>no</aside></article>", "T\n\nx"),
        ('<p class=a title="x>y">one</p><p a=1 a=2 hidden=until-found>two</p>', "one\n\ntwo"),
        ("a &lt; b &amp;amp; c&nbsp;d < e <1 </ p>", "a < b &amp; c d < e <1 </ p>"),
        ("<p>text <b never ends", "text <b never ends"),
        ("<article>x</article", "x</article"),
        ("<!-- a > b --><p>x<!-- open", "x"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


def test_long_and_hostile_pages_take_linear_time():
    for page in ("<a " * 60000, '<a "' * 60000, '<a b=">" ' * 60000, "<div>" * 30000 + "x", "<b>" * 30000 + "<p>x" * 30000, "<div></p>" * 30000, "<!--" * 30000, "<p " + "a=b " * 60000 + ">x"):
        begun = time.process_time()
        style_tree.style_nodes(page)
        main_text(page)
        assert time.process_time() - begun < 20, page[:20]
    long = "<article>" + "".join(f"<p>{prose(k, 50)}</p>" for k in range(4000)) + "</article>"
    assert main_text(long) == "\n\n".join(prose(k, 50) for k in range(4000))


def told(k, note="Terms apply to all that is said here."):
    return f"<body><div class='top'><i>Same on each page</i></div><article><h1>Same title</h1><p>{prose(k, 30)}</p><div class='note'>{note}</div><ul><li>{prose(k + 500, 4)}</li></ul></article></body>"


def frame(spark, rows):
    return spark.createDataFrame([(k, url, page, "x") for k, (url, page) in enumerate(rows)], "page_id long, url string, html string, low string")


def test_importance_against_plain_recomputation(spark):
    unmarked = "<div class='top'><p>Same words</p></div><div class='text'><p>{}</p><p>{}</p></div>"
    rows = [(f"https://a.example/{k}", told(k, "Terms." if k % 3 else f"Note {k % 4}")) for k in range(12)]
    rows += [("http://A.example:80/copy", told(3))] * 5 + [(f"https://b.example/{k}", unmarked.format(prose(k, 12), prose(k + 50, 9))) for k in range(6)] + [(None, None), (None, ""), ("x", "<p>")]
    articles = defaultdict(dict)
    for url, page in rows:
        key = style_tree.style_nodes(page or "")[0]
        held = articles[style_tree.site_of(url)].get(key)
        if held is None or style_tree._signed(style_tree._hash(page or "")) < style_tree._signed(style_tree._hash(held)):
            articles[style_tree.site_of(url)][key] = page or ""
    want = {}
    for site, pages in articles.items():
        values = defaultdict(lambda: (Counter(), Counter()))
        for page in pages.values():
            nodes, _ = style_tree.walk(page)
            path = lambda x: ((*path(x.parent), x.style) if x.parent else (x.style,))
            content = lambda x: tuple(" ".join(i.split()) if isinstance(i, str) else content(i) for i in x.items if (i.strip() if isinstance(i, str) else content(i)))
            seen = defaultdict(lambda: ([], []))
            hashed = {}
            for x in nodes:
                if not x.noise and x.tag not in style_tree.INLINE and not (x.main and x.tag in style_tree.HEADINGS):
                    seen[path(x)][0].append(tuple(x.children))
                    seen[path(x)][1].append(content(x))
                    hashed[path(x)] = x.path
            for p, (look, text) in seen.items():
                values[hashed[p]][0][tuple(look)] += 1
                values[hashed[p]][1][tuple(text)] += 1
        for node, (looks, texts) in values.items():
            m = sum(looks.values())
            if m > 1:
                look = -sum(c / m * math.log(c / m, m) for c in looks.values())
                text = 1 - sum(math.log(c, m) for c in texts.values()) / len(texts)
                want[site, node] = (m, round(0.1 * look + 0.9 * text, 9))
    got = style_tree.importance(frame(spark, rows)).where("m > 1").collect()
    assert {(r["site"], r["node"] & (1 << 64) - 1): (r["m"], round(abs(r["importance"]), 9)) for r in got} == {k: (m, abs(v)) for k, (m, v) in want.items()}
    assert any(v < style_tree.MIN_IMPORTANCE for _, v in want.values()) and any(v > 0.8 for _, v in want.values())


def test_site_judges_inside_articles(spark):
    rows = [(f"https://a.example/{k}", told(k)) for k in range(12)] + [(f"https://few.example/{k}", told(k)) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in style_tree.extract(frame(spark, rows)).collect()}
    for k in range(12):  # the note stands under each article of the site; titles may be equal
        assert got[k] == f"Same title\n\n{prose(k, 30)}\n\n{prose(k + 500, 4)}"
    for k in range(3):  # too few to tell
        assert "Terms apply" in got[12 + k]


def test_copies_do_not_remove_each_other(spark):
    edited = [told(1).replace("alpha", "omega", k % 2) for k in range(30)]
    rows = [("https://c.example/x", page) for page in edited] + [("https://d.example/x", PAGE)] * 20
    got = style_tree.extract(frame(spark, rows)).select("page_id", "text").collect()
    assert len(got) == 50 and all((r["text"] == main_text(rows[r["page_id"]][1])) and r["text"] for r in got)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "u", PAGE), (None, "u", PAGE), (1, None, None), (1, None, PAGE), (1, "u", "")]
    pages = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "page_id long, url string, html string, site int, text string, article int")
    got = style_tree.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in got.collect()) == Counter((i, u, main_text(p or ""), len(main_text(p or ""))) for i, u, p in rows)
    assert style_tree.importance(pages.limit(0)).count() == 0 and got.where(F.col("page_id").isNull()).count() == 2
