"""The operators for training text against brute force, on the smallest tables and on awkward rows."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from callejero.llm import (
    bpe, decontaminate, hierarchy, language, neardup, queries, repetition, sharding, tagpaths, texts, toxicity,
    urlfilter,
)

from callejero.session import scratch_dir

SF = "/root/testdata/sf0.001"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = " ".join(f"word{i % 97}x{i % 31}" for i in range(30_000))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "É é A a \u00a0 x"),
    (7, "same words here " * 40), (8, "same words here " * 40), (9, LONG), (10, "word " * 5_000),
    (11, "a" * 20_000), (12, "tab\tand\vvertical\ffeed\r\nline\n\nline\nline"), (13, "!!! ??? ###"), (None, "one two three"),
    (14, "日本語 のテキスト です"), (14, "日本語 のテキスト です"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, None if k % 3 == 0 else "en" if k % 2 else "fr", None if k % 5 == 0 else "hot", -1, "x")
            for k, (i, t) in enumerate(AWKWARD)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_words bigint, score string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- words and hashes ---------------------------------------------------------

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=8), st.booleans())
def test_words_are_those_of_the_pattern(rows, lower):
    rows = [r if r is None else r.encode("utf-8", "ignore").decode() for r in rows]
    got = []
    for block in texts.blocks(pa.array(rows, pa.string()), limit=30):
        found = texts.words(block, texts.LETTERS_DIGITS if lower else texts.NOT_SPACE, lower)
        data = texts.LOWER[block.data] if lower else block.data
        words = [data[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
        got += [words[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
    assert got == [ALNUM.findall(lowered(r)) if lower else SPACED.findall(r or "") for r in rows]


# -- 1: repetition ------------------------------------------------------------

def repeated(words, size):
    counts = collections.Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    hit = np.zeros(len(words), bool)
    for i in range(len(words) - size + 1):
        if counts[tuple(words[i:i + size])] > 1:
            hit[i:i + size] = True
    return int(hit.sum())


def base(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    again = repeated(words, 8)
    limits = repetition.Limits()
    failed = len(words) < 20 or 100 * again > 30 * len(words)
    longest = len(words) > limits.longest and repeated(words, limits.longest + 1) > 0
    share = repeated(words, limits.least)
    kept = not failed and 100 * share <= limits.share * len(words) and not longest
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            again, failed, kept)


def test_repetition_equals_brute_force(documents, awkward):
    for df in (documents, awkward):
        given_rows = collections.Counter((r.doc_id, base(r.text)) for r in df.collect())
        got = collections.Counter(
            (r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept))
            for r in repetition.judge(df).collect())
        assert got == given_rows


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=4))
def test_longest_repeats(rows):
    keys, ends, want = [], [], []
    for number, row in enumerate(rows):
        at = len(keys)
        keys += [number * 10 + x for x in row]
        ends += [at + len(row)] * len(row)
        for i in range(len(row)):
            longest = 0
            for j in range(len(row)):
                n = 0
                while j != i and max(i, j) + n < len(row) and row[i + n] == row[j + n]:
                    n += 1
                longest = max(longest, n)
            want.append(longest)
    got = repetition.longest_repeats(np.array(keys, dtype=np.uint64), np.array(ends, dtype=np.int64))
    assert got.tolist() == want


# -- 2: near copies -----------------------------------------------------------

def shingle_set(text, size):
    words = SPACED.findall(lowered(text))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def components(rows, size, percent=80):
    sets = {i: shingle_set(t, size) for i, t in rows}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited_copies(count, words, edits, seed):
    rng = np.random.default_rng(seed)
    base_words = [f"w{x}" for x in rng.integers(0, 500, words)]
    out = []
    for _ in range(count):
        copy = list(base_words)
        for at in rng.integers(0, words, edits):
            copy[at] = f"n{rng.integers(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for shingle in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(documents, shingle).collect()}
        assert got == components(rows, shingle)


def test_components_of_chains_and_crowds(spark):
    """Copies around the limit, whose links form chains, beside exact copies and a chain of growing edits."""
    rows = edited_copies(70, 150, 4, 1) + edited_copies(50, 150, 6, 2) + ["exact copy of a short text"] * 30
    chain = [f"c{i}" for i in range(120)]
    for step in range(25):
        rows.append(" ".join(chain))
        chain[4 * step] = f"d{step}"
    rows = [(i * 3 + 1, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(df, 4).collect()}
    assert got == components(rows, 4)


def test_components_of_awkward_rows(spark, awkward):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(awkward, 4).collect()}
    want = components([(i, t) for i, t in AWKWARD if i is not None], 4)
    assert got.pop(None) == (1, None)
    assert got == want
    assert neardup.components(awkward.limit(0)).collect() == []


# -- 3: toxicity --------------------------------------------------------------

def all_segments(scores):
    """Ruzzo and Tompa's definition, by recursion on the best segment."""
    if not scores or max(scores) <= 0:
        return []
    sums = np.concatenate([[0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], i - j, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)))
    _, _, i, j = best
    return (all_segments(scores[:i]) + [(i, j - 1, best[0])]
            + [(a + j, b + j, s) for a, b, s in all_segments(scores[j:])])


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.integers(1, 9), max_size=8))
def test_segments_are_all_maximal_ones(scores):
    line = [scores.get(i, -1) for i in range(max(scores, default=-1) + 1)]
    at = sorted(scores)
    got = toxicity.segments(at, [scores[i] for i in at], 1.0)
    assert sum(s for _, _, s in got) == pytest.approx(sum(s for _, _, s in all_segments(line)))
    assert max((s for _, _, s in got), default=0) == max((s for _, _, s in all_segments(line)), default=0)
    assert all(sum(line[a:b + 1]) == pytest.approx(s) for a, b, s in got)


def test_toxicity_learns_families_and_leaves_clean_texts(spark):
    rng = np.random.default_rng(3)
    plain = [f"plain{x}" for x in range(200)]
    rows, labels = [], []
    for i in range(600):
        words = [plain[x] for x in rng.integers(0, 200, 60)]
        toxic = i % 6 == 0
        if toxic:
            for at in rng.integers(0, 60, 4):
                words[at] = f"vile{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    from pyspark.sql import functions as F

    model = toxicity.train(docs, marks.filter("doc_id < 400"), F.col("doc_id") % 4 == 3)
    out = toxicity.passages(docs.filter("doc_id >= 400"), model).collect()
    assert all((r.score >= 0.3) == (r.doc_id % 6 == 0) for r in out)
    hit = next(r for r in out if r.doc_id % 6 == 0)
    assert all(s.high > s.low for s in hit.segments)


def test_toxicity_of_awkward_rows(spark, awkward):
    from pyspark.sql import functions as F

    none = toxicity.train(awkward, spark.createDataFrame([], "doc_id bigint, toxic int"), F.lit(True))
    assert all(r.score < 1e-9 for r in toxicity.passages(awkward, none).collect())
    labels = spark.createDataFrame([(7, 1), (9, 0), (10, 0), (12, 1), (1, None), (None, 1), (7, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(awkward, labels, F.col("doc_id") > 9)
    rows = toxicity.passages(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.passages(awkward.limit(0), model).collect() == []


# -- 4: quality ---------------------------------------------------------------

def test_quality_shrinks_sparse_sites(spark):
    rng = np.random.default_rng(5)
    good = lambda: ". ".join(" ".join(f"w{x}" for x in rng.integers(0, 3000, 9)) for _ in range(8))
    bad = lambda: " ".join(f"w{x}### |" for x in rng.integers(0, 30, 60))
    rows, labels = [], []
    for i in range(900):
        junk = i % 3 == 0
        site = "junk" if junk else "fine"
        if i % 50 == 1:
            site = f"small{i}"
        rows.append((i, bad() if junk else good(), site, "en"))
        if i < 500:
            labels.append((i, 0 if junk else 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    out = {r.doc_id: r for r in hierarchy.assess(docs, marks).collect()}
    assert all(r.kept == (i % 3 != 0) for i, r in out.items())
    sites = {rows[i][2]: r.site for i, r in out.items()}
    assert sites["junk"] < 0.1 and sites["fine"] > 0.9
    mean = np.mean([r.evidence for r in out.values()])
    small = [r.site for i, r in out.items() if rows[i][2].startswith("small")]
    assert all(abs(s - mean) < 1e-6 for s in small)  # a site of one document has no evidence but its own


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(7, 1), (9, 0), (10, 0), (12, 1), (1, None), (None, 1)], "doc_id bigint, quality int")
    rows = hierarchy.assess(awkward, labels).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.kept for r in hierarchy.assess(awkward, labels.limit(0)).collect())
    assert hierarchy.assess(awkward.limit(0), labels).collect() == []


# -- 5: addresses -------------------------------------------------------------

@pytest.mark.parametrize("url, host, path, rule", [
    ("http://A.Example.ORG/es/1?q#f", "a.example.org", "/es/1", "example.org/es/"),
    ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
    ("https://notexample.org/en/12", "notexample.org", "/en/12", "org/"),
    ("https://x.org", "x.org", "", None), ("x://y.com/fr/?a", "y.com", "/fr/", "com/fr/"),
    ("x://y.com?/fr/", "y.com", "", None), ("x://y.com#://b.org/", "y.com", "", None),
    ("no scheme", "", "", None), (None, "", "", None), ("", "", "", None), ("a://", "", "", None),
    ("ftp://É.COM/DE/", "É.com", "/DE/", None),
])
def test_rules_of_addresses(spark, url, host, path, rule):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(url,)], "u string").select(
        urlfilter.host_of(F.col("u")).alias("h"), urlfilter.path_of(F.col("u")).alias("p")).withColumn(
        "r", urlfilter.rule_of(F.col("h"), F.col("p"), queries.URL_RULES)).first()
    assert (row.h, row.p, row.r) == (host, path, rule)


def markov(counts, order, text):
    """Log-likelihood of a text by recursion on the context."""
    def chance(context, char):
        shorter = chance(context[1:], char) if context else 1 / urlfilter.ALPHABET
        seen = counts[context]
        total, kinds = sum(seen.values()), len(seen)
        return (seen[char] + kinds * shorter) / (total + kinds) if total else shorter

    padded = "\x02" * order + text + "\x03"
    return [np.log(chance(padded[i:i + order], padded[i + order])) for i in range(len(text) + 1)]


def test_character_models_equal_brute_force(spark):
    urls = [f"http://s{i % 7}.{'org' if i % 3 else 'com'}/{'fr' if i % 2 else 'de'}/{i % 13}" for i in range(80)]
    urls += [f"http://m{i % 5}.net/{'fr' if i % 2 else 'xx'}/{i}" for i in range(20)] + [None, "nothing"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").repartition(3)
    got = urlfilter.judge(df, queries.URL_RULES).collect()
    sides = {1: collections.defaultdict(collections.Counter), 0: collections.defaultdict(collections.Counter)}
    for r in got:
        text = r.host + r.path
        if r.rule and zlib.crc32(text.encode()) % 4:
            padded = "\x02" * 4 + text + "\x03"
            for i in range(len(text) + 1):
                for size in range(5):
                    sides[int(r.verdict == "allow")][padded[i + 4 - size:i + 4]][padded[i + 4]] += 1
    for r in got:
        if r.rule is None:
            text = r.host + r.path
            ratios = np.array(markov(sides[1], 4, text)) - np.array(markov(sides[0], 4, text))
            assert r.score == pytest.approx(ratios.mean(), abs=2e-6)
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert urlfilter.judge(df.limit(0), queries.URL_RULES).collect() == []


# -- 6: main text -------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li>More</ul></nav><div class="cookie-notice"><p>We use cookies, as all do.</div>
<!-- <p>comment</p> --><div class="content"><article><header><h1>Title &amp; more</h1></header><p>First <b>bold</b> line,
 with&nbsp;space.<p>Second &lt;line&gt; <a href="x>y">with a link</a>.<aside>Aside</aside><ul><li>One</li><li>Two</ul><p>Is.</p>
<form><p>Form</p></form><div class="ad">Buy, buy, buy now.</div><pre>a  b</pre><div style="display: none">hidden</div></article>
<section id="comments"><article class="comment"><p>I disagree, and at length, with all of this, as ever.</p></article></section></div>
<div id="sidebar"><p>Side text, with words.</p></div><footer>&copy; Foot</footer></body></html>"""


def test_main_text():
    assert tagpaths.main_text(PAGE).split("\n") == [
        "Title & more", "First bold line, with space.", "Second <line> with a link.", "One", "Two", "Is.", "a b"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp text", "plain & text"), ("<p>unfinished <b", "unfinished"),
    ("<p>a<script>x", "a"), ("<p>a<!-- x", "a"), ("a < b and <3", "a < b and <3"), ("</p></div>x", "x"),
    ("<div><p>one<p>two<br>three</div>", "one\ntwo three"), ("<nav>only</nav>", ""),
    ("<div class=content><p>One, two, three, four, five.</p><p>Six.</p></div><div class=menu>x</div>",
     "One, two, three, four, five.\nSix."),
])
def test_main_text_of_broken_pages(page, text):
    assert tagpaths.main_text(page) == text


LINKS = '<div class="links"><a href="/">Home of the site</a> <a href="/b">Another page</a></div>'
PROSE = "Long text, with words; and more words. Also more, and more, and more of it."


def test_main_text_is_whole_without_article():
    page = f"""<body>{LINKS}<div class="content"><h1>Title</h1><p>{PROSE}</p><ul><li>One</li><li>Two</li></ul>
<blockquote><p>Quote</p></blockquote><table><tr><td>Cell</td></tr></table>
<div class="s1"><h2>First</h2><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div><div class="s2"><h2>Second</h2><p>Short.</p></div>
<p><a href="/x">Source</a></p></div></body>"""
    assert tagpaths.main_text(page).split("\n") == [
        "Title", PROSE, "One", "Two", "Quote", "Cell", "First", PROSE, PROSE, PROSE, "Second", "Short.", "Source"]


@pytest.mark.parametrize("page, texts", [
    (f"<article id=post-1><p>{PROSE}<p>{PROSE}</article><article id=post-2><p>Two.</article>", [PROSE, PROSE, "Two."]),
    (f"<main><h1>Head</h1><article><p>{PROSE}<p>{PROSE}</article></main>", ["Head", PROSE, PROSE]),
    (f"<body>{LINKS}<h1>Head</h1><div class=text><p>{PROSE}<p>{PROSE}</div><ol><li>One</ol><div>Imprint</div>",
     ["Head", PROSE, PROSE, "One"]),
    (f"<body>{LINKS}<article></article><div class=text><p>{PROSE}<p>{PROSE}</div>", [PROSE, PROSE]),
    ("<body><a href=x>only links</a>", ["only links"]),
])
def test_main_text_keeps_what_belongs_to_it(page, texts):
    assert tagpaths.main_text(page).split("\n") == texts


def test_extract_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, None, "u", "old"), (2, "<p>new", None, None)], "page_id int, html string, url string, text string")
    assert sorted(map(tuple, tagpaths.extract(df).select("page_id", "url", "text").collect())) == [(1, "u", ""), (2, None, "new")]
    assert tagpaths.extract(df.limit(0)).collect() == []


# -- 7: decontamination -------------------------------------------------------

def hits(rows, items, window=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lowered(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i:i + window])].add(item)
    out = collections.Counter()
    for key, text in rows:
        words = ALNUM.findall(lowered(text))
        hit, found = np.zeros(len(words), bool), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit[i:i + size] = True
                    found |= windows[tuple(words[i:i + size])]
        out[(key, len(words), int(hit.sum()), tuple(sorted(map(str, found))))] += 1
    return out


def test_contamination_equals_brute_force(spark, documents, awkward):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    short = spark.createDataFrame(
        [(900, "One two"), (901, ""), (902, None), (903, "word"), (904, "same words here same words here same words here same words"),
         (905, "word " * 30), (906, "one TWO three!"), (906, LONG[500:3000]), (907, LONG[500:3000])], "item_id bigint, text string")
    for docs, items in ((documents, bench), (awkward, short), (documents, short), (awkward, bench.limit(0)), (awkward.limit(0), bench)):
        want = hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
        got = collections.Counter(
            (r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs, items).collect())
        assert got == want


def test_items_that_share_a_prompt_are_one_set(spark):
    """A window of many items is compared once, and its items come as one list."""
    prompt = "please answer the question below with one of the four options given here"
    items = [(f"q{i}", f"{prompt} number{i} asks about thing{i}") for i in range(300)] + [("s", "tiny item"), ("s2", "Tiny item!")]
    rows = [(i, f"before {prompt} after{i}") for i in range(40)] + [(50, "a tiny item here"), (51, prompt[7:]), (None, items[7][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert all(len(out[i].items) == 300 and out[i].n_hit == 13 for i in range(40))
    assert (out[50].items, out[50].n_hit) == (["s", "s2"], 2)
    assert (len(out[51].items), out[51].n_hit, len(out[None].items), out[None].n_hit) == (300, 12, 300, 17)
    _, sets = decontaminate._sets(decontaminate.item_windows(bench, "item_id", "text", 10, 5), scratch_dir(spark, "sets"))
    assert sorted(len(r["items"]) for r in sets.collect())[-2:] == [2, 300] and sets.count() == 302


# -- 8: language --------------------------------------------------------------

def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.op8_language(spark, "/root/testdata/sf0.01").filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) > 250 and np.mean([r.lang == r.lang_pred for r in out]) >= 0.98
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)


def test_codewords_differ():
    for count in range(2, 41):
        codes = language.codewords(count)
        assert len(np.unique(codes, axis=0)) == count
        assert (np.abs(codes.sum(axis=0)) < count).all()


def test_language_of_awkward_rows(spark, awkward):
    model = language.train(awkward)
    rows = language.predict(awkward, model).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(AWKWARD)
    assert [got[i] for i in (1, 2, 3, 13)] == [("und", 0.0)] * 4
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "fr", "und") for r in rows)
    nothing = language.train(awkward.limit(0))
    assert {r.lang_pred for r in language.predict(awkward, nothing).collect()} == {"und"}
    one = language.train(awkward.filter("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language.predict(awkward, one).collect()} == {("und", 0.0), ("en", 1.0)}


# -- 9: tokens ----------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tokens_equal_the_library(awkward, documents, ranks, library):
    for df in (awkward, documents):
        got = bpe.encode(df.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
        rows = bpe.decode(got, ranks).collect()
        assert rows and all(r.ids == library.encode_ordinary(r.text or "") for r in rows)
        assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(ranks, library, text):
    text = text.encode("utf-8", "ignore").decode()
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN)
    ids = codec.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abeht nrs", min_size=40, max_size=200))
def test_long_words_merge_like_short_ones(ranks, text):
    word = text.encode()
    assert bpe._fold_long(word, ranks) == _plain(word, ranks)


def _plain(word, ranks):
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        at = min(found)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


def test_fold_as_higher_order_function(spark, ranks, library):
    words = [" thentre", "!!!", "ciónrr", "a", "zxqjkvb", " hello", "", "ß"]
    df = spark.createDataFrame([(bytearray(w.encode()),) for w in words], "word binary")
    got = bpe.fold_words(df, bpe.rank_map(ranks)).collect()
    assert all(r.ids == library.encode_ordinary(bytes(r.word).decode()) for r in got)


def test_token_digests(awkward, ranks, library):
    for r in bpe.digests(awkward, ranks, public_tokenizers.PATTERN).collect():
        text = next(t for i, t in AWKWARD if i == r.doc_id)
        ids = library.encode_ordinary(text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# -- 10: shards ---------------------------------------------------------------

@pytest.mark.parametrize("shards", [1, 7, 16])
def test_shards_match_the_mixture(spark, documents, awkward, shards):
    for df in (documents, awkward):
        rows = sharding.interleave(df, shards, "s").collect()
        source = {r.doc_id: (r.source, r.text) for r in df.collect()}
        sizes = collections.Counter(r.shard for r in rows)
        counts = [sizes[s] for s in range(shards)]
        assert sum(counts) == df.count() and max(counts) - min(counts) <= 1
        for s in range(shards):
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
        n = collections.Counter(source[r.doc_id][0] for r in rows)
        for (name, s), got in collections.Counter((source[r.doc_id][0], r.shard) for r in rows).items():
            assert abs(got - n[name] * counts[s] / len(rows)) <= len(n) + 1
        for r in rows:
            text = (source[r.doc_id][1] or "").encode()
            assert (r.size, r.text_crc32) == (len(text) + 1, zlib.crc32(text))
    assert sharding.interleave(awkward.limit(0), shards, "s").collect() == []


# -- queries and pipeline -----------------------------------------------------

def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def duck():
    from pathlib import Path

    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    from tools.check import normalised

    df = queries.QUERIES[name](spark, SF)
    result = duck.execute(queries.ORACLES[name])
    assert normalised(df.columns, df.collect()) == normalised([d[0] for d in result.description], result.fetchall())


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept; the models' stages by what they must keep and drop."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SF)
        after = docs.collect()
        ids = {r.doc_id for r in after}
        assert len(ids) == len(after) and ids <= set(before)
        if name == "language":
            assert ids == {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
        elif name == "quality":
            assert np.mean([i in ids for i in before if labels.get(i) == 1]) > 0.97
            assert np.mean([i in ids for i in before if labels.get(i) == 0]) < 0.2
        elif name == "near copies":
            groups = collections.Counter(c for _, c in components(list(before.items()), 5).values())
            kept = collections.Counter(components(list(before.items()), 5)[i][1] for i in ids)
            assert set(kept) == set(groups) and set(kept.values()) == {1}
        elif name == "decontamination":
            assert ids == {k[0] for k in hits(before.items(), items) if not k[2]}
        else:
            assert ids == set(before) and all(r.round_trip and len(r.ids) == r.n_tokens for r in after)
        if name != "tokens":
            assert docs.columns == columns


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "round_trip"]
    assert 0 < rows.count() < 200


def test_stages_of_awkward_rows(spark, awkward):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = awkward.withColumnRenamed("n_words", "n_chars").select(*columns)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, SF).collect()


STAGE = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_rows_are_rejected_one_by_one(spark, kind):
    """Missing and repeated ids, ids that are text, and columns with the operators' names."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    plain = " ".join(f"own{i} words{i} here{i}" for i in range(40))
    ids = [None, None, 7, 7, 7] if kind == "bigint" else [None, None, "x7", "x7", "x7"]
    rows = [(i, t, "en", "s", n, "mine", True, "p", -1.5) for n, (i, t) in enumerate(
        zip(ids, [plain, plain, plain + " more", f"before it {item} and after", "something else entirely, in words"]))]
    df = spark.createDataFrame(
        rows, f"doc_id {kind}, text string, lang string, source string, n_chars int, score string, ambiguous boolean, lang_pred string, p double")
    one = STAGE["near copies"](spark, df, SF)
    assert one.columns == df.columns
    assert sorted(r.n_chars for r in one.collect())[1:] == [3, 4] and one.count() == 3
    clean = STAGE["decontamination"](spark, df, SF).collect()
    assert sorted(r.n_chars for r in clean) == [0, 1, 2, 4]
    for name in ("language", "quality"):
        out = STAGE[name](spark, df, SF)
        assert out.columns == df.columns and out.dtypes == df.dtypes
        assert all((r.score, r.ambiguous, r.lang_pred, r.p) == ("mine", True, "p", -1.5) for r in out.collect())


def test_a_corpus_without_languages_keeps_its_texts(spark):
    df = spark.createDataFrame([(1, "words", None, "s", 1), (2, None, None, "s", 1), (3, "12 !", None, "s", 1), (4, "é", None, "s", 1)],
                               "doc_id int, text string, lang string, source string, n_chars int")
    assert {r.doc_id for r in STAGE["language"](spark, df, SF).collect()} == {1, 4}
