"""The fitted operators against plain versions of the same models, by dictionaries and loops."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from callejero.llm import hierarchy, language, neardup, queries, texts, toxicity

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rest(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def auc(pairs):
    ones, zeros = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros])


# -- toxicity ------------------------------------------------------------------

def words_of(text):
    return [w.encode() for w in WORD.findall((text or "").translate(UPPER))]


def lexicon(rows):
    """Log-odds of every prefix and word that says something: {(level, bytes): (odds, n0)}."""
    counts = collections.defaultdict(lambda: [0, 0])
    parent = {}
    for text, toxic in rows:
        for word in words_of(text):
            above = None
            for level, depth in enumerate(toxicity.DEPTHS):
                if len(word) > depth:
                    key = level, word[:depth]
                    counts[key][toxic] += 1
                    parent[key], above = above, key
            key = len(toxicity.DEPTHS), word
            counts[key][toxic] += 1
            parent[key] = above
    whole = [counts[k] for k in counts if k[0] == len(toxicity.DEPTHS)]
    toxic, clean = sum(c[1] for c in whole), sum(c[0] for c in whole)
    root = toxic / (toxic + clean)
    share = {}

    def share_of(key):
        if key is None:
            return root
        if key not in share:
            n0, n1 = counts[key]
            own = (n1 + toxicity.PRIOR * share_of(parent[key])) / (n0 + n1 + toxicity.PRIOR)
            share[key] = min(max(own, toxicity.SURE), 1 - toxicity.SURE)
        return share[key]

    def odds(p):
        return math.log(p / (1 - p)) - math.log(root / (1 - root))

    out = {}
    for key, (n0, n1) in counts.items():
        own, before = odds(share_of(key)), odds(share_of(parent[key]))
        if (own >= toxicity.LEAST and n1 >= 2 and own - before >= 0.5) or (before >= toxicity.LEAST and before - own >= 0.5):
            out[key] = own, n0
    return out, clean


def token_scores(found, text):
    """The last level that knows a word decides."""
    out = []
    for at, word in enumerate(words_of(text)):
        score = None
        for level, depth in enumerate(toxicity.DEPTHS):
            if len(word) > depth:
                score = found.get((level, word[:depth]), (score,))[0]
        score = found.get((len(toxicity.DEPTHS), word), (score,))[0]
        if score is not None:
            out.append((at, score))
    return out


def root_of(found, clean):
    """lambda with E[exp(lambda score)] = 1, by bisection."""
    shares = [((n0 + 0.5) / (clean + 0.5 * len(found) + 1), odds) for odds, n0 in found.values()]
    left = max(1 - sum(p for p, _ in shares), 1e-9)
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        total = sum(p * math.exp(min(middle * odds, 700)) for p, odds in shares) + left * math.exp(-middle * toxicity.DRIFT)
        low, high = (low, middle) if total > 1 else (middle, high)
    return high


def test_toxicity_equals_a_plain_version(spark, docs, labels):
    given = {i: int(r.toxic > 0) for i, r in labels.items() if r.toxic is not None and rest(i, 4) != 2}
    learn = [(docs[i].text, y) for i, y in given.items() if i in docs and rest(i, 4) != 3]
    held = [(docs[i].text, y) for i, y in given.items() if i in docs and rest(i, 4) == 3]
    found, clean = lexicon(learn)
    lam = root_of(found, clean)

    def best(text, found):
        at = token_scores(found, text)
        segments = toxicity.segments([a for a, _ in at], [s for _, s in at], toxicity.DRIFT)
        return len(words_of(text)), segments

    quiet = [best(t, found) for t, y in held if not y]
    over = sum(max((s for *_, s in segments), default=0) >= toxicity.LEAST for _, segments in quiet)
    chance = (over + 0.5) / (len(quiet) + 1)
    k = -math.log1p(-chance) * math.exp(lam * toxicity.LEAST) / max(np.mean([n for n, _ in quiet]), 1.0)

    def total(text, found):
        n, segments = best(text, found)
        values = [lam * s - math.log(k * max(n, 1)) for *_, s in segments]
        return sum(v for v in values if v >= -math.log(toxicity.EXPECTED))

    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    marks = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").filter(queries._remainder(4) != 2)
    model = toxicity.train(table, marks, queries._remainder(4) == 3)
    assert (model.lam, model.k) == (pytest.approx(lam), pytest.approx(k))
    # the sums of calibration texts under the first lexicon fix the curve
    sums = np.log1p([total(t, found) for t, _ in held])
    y = np.array([y for _, y in held], dtype=float)
    sizes = collections.Counter(y for i, y in given.items() if rest(i, 4) == 3)
    weight = np.array([sizes[int(one)] / (y == one).sum() for one in y])
    assert (model.intercept, model.slope) == pytest.approx(toxicity._logistic(sums, y, weight / weight.mean()), rel=1e-6)
    # tokens are then learned from all
    found, _ = lexicon(learn + held)
    for level in range(len(toxicity.DEPTHS) + 1):
        want = sorted(odds for (of, _), (odds, _) in found.items() if of == level)
        assert sorted(model.odds[level].tolist()) == pytest.approx(want)
    got = {r.doc_id: r for r in queries.op3_toxicity(spark, SF).collect()}
    for i, r in docs.items():
        score = 1 / (1 + math.exp(-min(max(model.intercept + model.slope * math.log1p(total(r.text, found)), -40), 40)))
        assert got[i].score == pytest.approx(score, abs=1e-9)
        assert (got[i].held_out, got[i].predicted) == (rest(i, 4) == 2, int(score >= 0.3))


def test_tokens_that_only_toxic_texts_have(spark):
    """Shares near one on every level must not become infinite odds."""
    rows = [(i, "villainously " * 20_000 if i % 2 else "plain words of a text") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, marks, F.col("doc_id") > 5)
    assert all(np.isfinite(o).all() for o in model.odds)
    out = {r.doc_id: r.predicted for r in toxicity.passages(docs, model).selectExpr("doc_id", "score >= 0.3 AS predicted").collect()}
    assert out == {i: i % 2 == 1 for i in range(8)}


# -- language ------------------------------------------------------------------

def trigram_slots(text):
    line, last = " ", " "
    for c in text.lower():
        c = c if c.isalpha() else " "
        if not (c == " " and last == " "):
            line += c
        last = c
    line += "" if last == " " else " "
    out = []
    for a, b, c in zip(line, line[1:], line[2:]):
        mixed = ((ord(a) * 0x9E3779B1 % 2**32 ^ ord(b)) * 0x85EBCA77) % 2**32
        mixed = ((mixed ^ mixed >> 15 ^ ord(c)) * 0xC2B2AE3D) % 2**32
        out.append(mixed >> 32 - language.SLOTS.bit_length() + 1)
    return out


def test_language_equals_a_plain_version(spark, docs):
    learn = [r for r in docs.values() if rest(r.doc_id, 3) != 1 and r.lang is not None and r.text is not None]
    names = sorted({r.lang for r in learn})
    counts = {n: collections.Counter() for n in names}
    for r in learn:
        counts[r.lang].update(trigram_slots(r.text))
    share = {n: [(counts[n][s] + 0.5) / (sum(counts[n].values()) + 0.5 * language.SLOTS) for s in range(language.SLOTS)] for n in names}
    codes = language.codewords(len(names)).tolist()
    bits = []
    for bit in range(len(codes[0])):
        ones = [share[n] for n, c in zip(names, codes) if c[bit] > 0]
        zeros = [share[n] for n, c in zip(names, codes) if c[bit] < 0]
        odds = [math.log(sum(a) / len(a)) - math.log(sum(b) / len(b)) for a, b in zip(zip(*ones), zip(*zeros))]
        low = min(sum(p * w for p, w in zip(s, odds)) for s in ones)
        high = max(sum(p * w for p, w in zip(s, odds)) for s in zeros)
        gap = max(low - high, 1e-6)
        bits.append((odds, (low + high) / 2, 2 * language.MARGIN / gap, gap))
    mean_gap = sum(b[3] for b in bits) / len(bits)
    got = {r.doc_id: r for r in queries.op8_language(spark, SF).collect()}
    for i, r in docs.items():
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        slots = trigram_slots(r.text)
        loss = [0.0] * len(names)
        for b, (odds, middle, scale, gap) in enumerate(bits):
            out = min(max((sum(odds[s] for s in slots) / len(slots) - middle) * scale, -30), 30)
            for n in range(len(names)):
                loss[n] += gap / mean_gap * math.log1p(math.exp(-out * codes[n][b]))
        chances = [math.exp(min(loss) - v) for v in loss]
        assert got[i].lang_pred == names[loss.index(min(loss))]
        assert got[i].score == pytest.approx(max(chances) / sum(chances), abs=1e-4)   # weights are 32-bit
        assert got[i].held_out == (rest(i, 3) == 1)


# -- quality -------------------------------------------------------------------

def test_hierarchy_equals_a_plain_version(spark, docs, labels):
    table, marks = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = hierarchy.train(table, marks, "doc_id", "text", "quality")
    got = {r.doc_id: r for r in queries.op4_hierarchy(spark, SF).collect()}
    p = {}
    for i, r in docs.items():
        (block,) = texts.blocks(pa.array([r.text], pa.string()))
        p[i] = 1 / (1 + math.exp(-model.logit(block)[0]))
        assert got[i].evidence == pytest.approx(p[i], abs=1e-9)
    section, site = collections.defaultdict(list), collections.defaultdict(list)
    for i, r in docs.items():
        section[r.source, r.lang].append(p[i])
        site[r.source].append(p[i])
    mean = min(max(sum(p.values()) / len(p), 1e-4), 1 - 1e-4)

    def strength(groups):
        """Of (values, centre) pairs."""
        big = [(len(v), sum(v), c) for v, c in groups if len(v) > 1]
        between = sum((k - n * c) ** 2 / n for n, k, c in big)
        within, room = sum(c * (1 - c) for _, _, c in big), sum((n - 1) * c * (1 - c) for n, _, c in big)
        rho = max((between - within) / room, 1 / (hierarchy.LIMIT + 1)) if room else 1 / (hierarchy.LIMIT + 1)
        return min(max(1 / min(rho, 0.5) - 1, 1.0), hierarchy.LIMIT)

    s1 = strength([(v, mean) for v in site.values()])
    centre = {h: (sum(v) + s1 * mean) / (len(v) + s1) for h, v in site.items()}
    s2 = strength([(v, centre[h]) for (h, _), v in section.items()])
    for i, r in docs.items():
        a, b = site[r.source], section[r.source, r.lang]
        own = (sum(a) - p[i] + s1 * mean) / (len(a) - 1 + s1)
        inner = (sum(b) - p[i] + s2 * own) / (len(b) - 1 + s2)
        odds = sum(w * math.log(min(max(q, 1e-6), 1 - 1e-6) / (1 - min(max(q, 1e-6), 1 - 1e-6))) for q, w in ((p[i], 1), (inner, 1), (mean, -1)))
        score = 1 / (1 + math.exp(-odds))
        assert (got[i].site, got[i].section, got[i].score) == pytest.approx((own, inner, score), abs=1e-6)
        assert got[i].kept == (got[i].score >= 0.5)


def test_quality_of_rows_not_learned_from(spark):
    sf = "/root/testdata/sf0.01"
    table, marks = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = queries._remainder(4) == 2
    out = hierarchy.assess(table, marks.filter(~held)).join(marks.filter(held).select("doc_id", "quality"), "doc_id").collect()
    assert auc([(r.score, r.quality) for r in out]) > 0.95
    assert np.mean([r.kept for r in out if r.quality]) > 0.95


# -- near copies: groups that hold much of the rows ----------------------------------

def test_hot_classes_and_buckets(spark):
    """Copies of one text, empty texts, and a bucket of similar texts that are not linked."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, "one text that many rows hold " * 4) for i in range(150)] + [(200 + i, "" if i % 2 else None) for i in range(60)]
    for i in range(60):   # pairwise similar below the limit: the same frame with own words
        own = [f"x{i}y{k}" for k in range(12)]
        rows.append((300 + i, " ".join(base + own)))
    rows += [(400 + i, rows[215 + i][1] + f" tail{i}") for i in range(8)]
    rng.shuffle(rows)
    rows = [(int(i), t if t is None else str(t)) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(df, 5).collect()}

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()

    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    order = sorted(sets)
    for n, a in enumerate(order):
        for b in order[n + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
