"""Main text: what the path ratios decide, names that mark, broken and extreme pages."""

import collections
import random
import time
import tracemalloc

import pyarrow.parquet as pq
import pytest

from callejero.llm import queries, tagpaths

PROSE = "Long text, with words; and more words. Also more, and more, and more of it."


@pytest.mark.parametrize("page, texts", [
    # marks count as whole names only
    (f'<article class="post category-social"><p>{PROSE}</article>', [PROSE]),
    (f'<div class="content-sidebar-wrap"><main><p>{PROSE}</main></div>', [PROSE]),
    (f'<div class="entry-content with-ads"><p>{PROSE}</div>', [PROSE]),
    (f'<article><p>{PROSE}<div class="search-results"><p>Found, in prose.</div><p class="market-share">Half.</article>',
     [PROSE, "Found, in prose.", "Half."]),
    (f'<article><p>{PROSE}<div class="ad-slot"><p>{PROSE}</div><div id="site-footer">x</div><p class="cookieNotice">y</article>', [PROSE]),
    # never on what holds the weight, but for discussions
    (f'<div class="widget"><p>{PROSE}<p>{PROSE}</div><p>Imprint.', [PROSE, PROSE, "Imprint."]),
    (f'<div class="sidebar"><article><p>{PROSE}</article></div>', [PROSE]),
    (f'<article><p>Short.</article><div class="comments"><p>{PROSE}<p>{PROSE}</div>', ["Short."]),
    (f'<p>Short.<div id="comments"><p>{PROSE}<p>{PROSE}</div>', ["Short."]),
    # teasers beside the content
    (f'<main><p>{PROSE}<p>{PROSE}</main><article><a href=/t>Teaser</a></article>', [PROSE, PROSE]),
    (f'<div class=text><p>{PROSE}<p>{PROSE}</div>' + '<article><h3>Card</h3><p>More here.</article>' * 6, [PROSE, PROSE]),
    (f'<article><p>{PROSE}</article><article><p>Two.</article>', [PROSE, "Two."]),
    # a notice without a telling name, on a page with a menu
    (f'<nav><a href=/>Home</a></nav><div class=x>Read this.</div><div class=y><p>{PROSE}<p>{PROSE}</div>', [PROSE, PROSE]),
    # quotes that are none
    (f'<p>{PROSE}<img {" ".join(f"a{i}" for i in range(30))} alt=5"><p>End', [PROSE, "End"]),
    (f'<p>{PROSE}<p title=">" data-x=\'>\' >End', [PROSE, "End"]),
    (f'<p>{PROSE}<p title="never closed>End', [PROSE, "End"]),
])
def test_main_text_of(page, texts):
    assert tagpaths.main_text(f"<body>{page}</body>").split("\n") == texts


def by_dictionary(page):
    """Smoothed ratio of every block, with whole paths as keys."""
    tree = tagpaths.Tree(page)
    paths = []
    for element, _, _ in tree.blocks:
        path = []
        while element:
            path.append(tree.path[element])
            element = tree.parent[element]
        paths.append(tuple(path))
    groups = collections.defaultdict(list)
    for path, (_, text, linked) in zip(paths, tree.blocks):
        groups[path].append((max(len(text) - linked, 0), sum(c in ".,;:!?¿¡…。，、；：！？" for c in text)))
    ratio = []
    for path in paths:
        own = groups[path]
        ratio.append(sum(c for c, _ in own) / len(own) * (1 + sum(m for _, m in own) / len(own)))
    smooth = [(ratio[max(i - 1, 0)] + 2 * r + ratio[min(i + 1, len(ratio) - 1)]) / 4 for i, r in enumerate(ratio)]
    return ratio, smooth, tree


def pages():
    draw = random.Random(5)
    kinds = ["div", "p", "li", "section", "article", "td", "h2"]
    out = pq.read_table("/root/testdata/sf0.001/pages.parquet")["html"].to_pylist()
    for _ in range(60):
        page = ""
        for _ in range(40):
            kind = draw.choice(kinds)
            page += draw.choice([f"<{kind}>", f"<{kind} class={draw.choice('ab')}>", f"</{kind}>", "text, words. " * draw.randrange(6), "<a href=x>link</a>"])
        out.append(page)
    return out


def test_ratios_equal_brute_force():
    for page in pages():
        ratio, smooth, tree = by_dictionary(page)
        got = tagpaths.ratios(tree)
        assert got[0] == pytest.approx(ratio) and got[1] == pytest.approx(smooth)
        values = [float(i + 1) for i in range(len(tree.blocks))]
        summed = tree.summed(values)
        for element in range(len(tree.name)):
            inside = sum(v for v, (e, _, _) in zip(values, tree.blocks) if element <= e <= tree.last[element])
            assert summed[element] == pytest.approx(inside)


def test_ratios_find_the_text_without_names():
    """The given pages without their article element and the advert's class: most give the same text."""
    given = pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()
    bare = [p.replace('<div class="ad">', '<div class="x">').replace("<article>", '<div class="y">').replace("</article>", "</div>") for p in given]
    assert all("<article" not in p for p in bare)
    same = sum(tagpaths.main_text(a) == tagpaths.main_text(b) for a, b in zip(given, bare))
    assert same / len(given) > 0.9


@pytest.mark.parametrize("page", [
    "<div>x " * 20_000, '<p>x<img ' + " " * 60 + 'alt="', "<p>x" + '<img a="' * 3_000, "<p " + "a=' " * 30_000,
    "<" * 100_000, "<p>" + "&" * 100_000, "<p>" + "<!-- " * 20_000, "<li>a" * 30_000, "</div>" * 50_000, "<p>word. " * 30_000,
])
def test_extreme_pages_take_linear_time_and_memory(page):
    tracemalloc.start()
    started = time.perf_counter()
    tagpaths.main_text(page)
    took, most = time.perf_counter() - started, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 20 and most < 200e6


def test_repeated_rows_and_a_long_page(spark):
    long = "<article>" + f"<p>{PROSE}" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", long), (1, "u", long), (2, None, "<p>a")], "page_id int, url string, html string")
    rows = sorted((r.page_id, len(r.text)) for r in tagpaths.extract(df).collect())
    assert rows == [(1, 20_000 * (len(PROSE) + 1) - 1)] * 2 + [(2, 1)]


def test_query_is_the_operator_on_every_page(spark):
    sf = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf}/pages.parquet").to_pylist()
    want = {(r["page_id"], r["url"], t, len(t)) for r in table for t in [tagpaths.main_text(r["html"])]}
    assert {tuple(r) for r in queries.op6_tag_paths(spark, sf).select("page_id", "url", "text", "n_chars").collect()} == want
