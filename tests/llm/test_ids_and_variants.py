"""Spelling variants, token files and importance resampling against brute force."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callejero.llm import queries, resample, spelling, texts, tokenfiles

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, n long, word string, rank string, part int"
AWKWARD = [
    (3, "one two three", 1, "w", "r", 0), (3, "one two three", 1, "w", "r", 0), (None, "lonely words", 1, None, None, 1),
    (None, None, 1, "w", "r", 0), (2, None, 1, "w", "r", 0), (1, "", 1, "w", "r", 0), (9, "Ünï 日本語 x's  \n\n 'll!!", 1, "w", "r", 0),
    (8, "word" * 9_000, 1, "w", "r", 0), (7, " ".join(f"w{i % 301}" for i in range(30_000)), 1, "w", "r", 0),
]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(spark):
    return [(r.doc_id, r.text) for r in documents(spark).select("doc_id", "text").collect()]


# -- resampling ----------------------------------------------------------------

def features(text, longest=3):
    words = WORD.findall((text or "").translate(UPPER))
    return len(words), [zlib.crc32(" ".join(words[i:i + n]).encode()) for n in range(1, longest + 1)
                        for i in range(len(words) - n + 1)]


def drawn(rows, target, percent=5, least=20):
    s, t = collections.Counter(), collections.Counter()
    found = {}
    for i, text in rows:
        n, crcs = features(text)
        found[i] = n, [c % 10000 for c in crcs]
        s.update(found[i][1])
    for text in target:
        t.update(c % 10000 for c in features(text)[1])
    a, b = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = {}
    for i, (n, buckets) in found.items():
        weight = sum(math.floor(1000 * math.log((t[k] + 1) * a / ((s[k] + 1) * b))) for k in buckets)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n]
    order = sorted((i for i in out if out[i][4] >= least), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(order[:percent * len(order) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v[:4]) for i, v in out.items()}


def test_resample_equals_brute_force(spark):
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in queries.op13_resample(spark, SF).collect()}
    want = drawn(rows_of(spark), target)
    assert got == want
    assert sum(r[3] is not None for r in got.values()) == len([1 for i, t in rows_of(spark) if features(t)[0] >= 20]) * 5 // 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab1é -", max_size=30), st.text(max_size=20)), min_size=1, max_size=5))
def test_prefix_crcs_are_those_of_the_runs(rows):
    rows = [r if r is None else r.encode("utf-8", "ignore").decode() for r in rows]
    got = []
    for block in texts.blocks(pa.array(rows, pa.string()), limit=40):
        found = texts.words(block, texts.LETTERS_DIGITS, lower=True)
        for size, (at, crcs) in enumerate(resample.ngram_crcs(found), 1):
            got += [(block.low + int(o), size, int(c)) for o, c in zip(found.text[at], crcs)]
    want = [(i, size, zlib.crc32(" ".join(w[k:k + size]).encode())) for i, r in enumerate(rows)
            for w in [WORD.findall((r or "").translate(UPPER))] for size in (1, 2, 3) for k in range(len(w) - size + 1)]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("length", [0, 1, 127, 128, 129, 1000, 70_001])
def test_shift_is_that_many_zero_bytes(length):
    state = np.array([1, 0x80000000, 0xDEADBEEF], dtype=np.uint32)
    got = resample.shifted(state, np.full(3, length))
    # crc(a + zeros) for equal lengths differs by what the shift makes of the difference of the registers
    pad = bytes(length)
    for a, b in (("x", "y"), ("hello", "world")):
        x, y = zlib.crc32(a.encode()), zlib.crc32(b.encode())
        whole = zlib.crc32(a.encode() + pad) ^ zlib.crc32(b.encode() + pad)
        assert int(resample.shifted(np.array([x ^ y], dtype=np.uint32), np.array([length]))[0]) == whole
    assert len(got) == 3


def test_resample_of_awkward_rows(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    got = resample.resample(df, df, percent=50, least_words=2).collect()
    assert len(got) == len(AWKWARD)
    # eligible: both of id 3, the lonely one, 9 and 7 (the word of 36,000 letters is one word)
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 5 * 50 // 100 + 1))
    nothing = {(r.doc_id, r.n_features, r.weight) for r in got if r.n_features == 0}
    assert nothing == {(None, 0, 0), (2, 0, 0), (1, 0, 0)}
    assert len({(r.n_features, r.weight, r.score) for r in got if r.doc_id == 3}) == 1
    empty = df.filter("false")
    assert resample.resample(empty, df).count() == 0
    # an empty target: the smoothing alone decides
    want = drawn([r[:2] for r in AWKWARD], [])
    assert {(r.doc_id, r.weight) for r in resample.resample(df, empty).collect() if r.doc_id} == {(i, v[1]) for i, v in want.items() if i}


# -- spelling ------------------------------------------------------------------

def variant_table(rows, least=6, least_count=5, times=5, every=199):
    counts = collections.Counter()
    for i, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}
    skipped = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            skipped[w[:i], w[i + 1:]].add(w)
    near = {w: set() for w in words}
    for (a, b), members in skipped.items():
        for w in members:
            near[w] |= members - {w}
            if a + b in words:
                near[w].add(a + b)
                near[a + b].add(w)
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= times * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_equal_brute_force(spark):
    assert found(queries.op11_spelling(spark, SF)) == variant_table(rows_of(spark))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text(alphabet="abÿ", min_size=1, max_size=5), min_size=1, max_size=30), st.integers(1, 3))
def test_variants_of_few_letters(spark, words, times):
    # runs of equal letters, chains of forms, words that are beginnings of others; several partitions
    rows = [(i, " ".join(words[i::3])) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = spelling.variants(df, least=1, least_count=1, times=times + 1, drop_every=3)
    assert found(got) == variant_table(rows, 1, 1, times + 1, 3)


def test_nodes_over_partition_borders():
    words = sorted({"a" * i for i in range(1, 30)} | {"ab", "abc", "abcd", "b", "ba", "baa", "bab"})
    for size in (1, 2, 5):
        parts = [words[i:i + size] for i in range(0, len(words), size)]
        carried = spelling._carried([(k, p[0], p[-1]) for k, p in enumerate(parts)])
        numbers = {}
        for k, part in enumerate(parts):
            left, right, first, last = carried[k]
            for word in part:
                for depth in range(len(word)):
                    if depth < min(len(left), spelling._shared(word, first)):
                        number = left[depth]
                    elif depth < min(len(right), spelling._shared(word, last)):
                        number = right[depth]
                    else:
                        number = (k, word[:depth + 1])
                    assert numbers.setdefault(word[:depth + 1], number) == number
        assert len(set(numbers.values())) == len(numbers)


def test_variants_of_awkward_rows(spark):
    rows = AWKWARD + [(i, "frequent Frequent FREQUENT frequenT fraquent", 1, "w", "r", 0) for i in range(20, 27)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(spelling.variants(df))
    assert got == variant_table([r[:2] for r in rows])
    assert {(w, f) for w, f, *_ in got} >= {("frequent", None)}
    assert spelling.variants(df.filter("false")).count() == 0
    assert spelling.variants(df.filter("text IS NULL")).count() == 0


# -- token files ---------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as lines:
        return lines.read()


@pytest.fixture(scope="module")
def library(tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_str(tokenizer)
    own.encode_special_tokens = True
    return own


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=50))
def test_code_round_trip(values):
    control, data = tokenfiles.pack(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(1 + (v > 255) + (v > 65535) + (v > 2**24 - 1) for v in values)
    assert tokenfiles.unpack(control, data, len(values)).tolist() == values


PIECES = ["ab", "'s", "'re", "'ll", "'d", "'", "''", " ", "  ", "\n", "\t ", "1", "12", ".", "é", "ß²", "ñ'", "<|endoftext|>", "S", "'S", "日", "\xa0", "\x1c", "\x85", "r", "v", "ɐ", "½", "÷"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.lists(st.sampled_from(PIECES), max_size=14).map("".join)), min_size=1, max_size=5))
def test_ids_equal_the_library(tokenizer, library, held):
    held = [t and t.encode("utf-8", "ignore").decode() for t in held]
    encoder = tokenfiles._encoder(tokenizer)
    got = [i.tolist() for block in texts.blocks(pa.array(held, pa.string()), limit=60) for i in encoder.ids(block)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in held]


def test_words_are_forgotten_and_met_again(tokenizer, library, monkeypatch):
    monkeypatch.setattr(tokenfiles, "WORDS_KEPT", 5)
    encoder = tokenfiles.Encoder(tokenizer)
    held = [f"some w{i % 7} and x{i % 3}, {'long' * 300}" for i in range(40)]
    for _ in range(2):
        got = [i.tolist() for block in texts.blocks(pa.array(held), limit=50) for i in encoder.ids(block)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in held]
    assert len(encoder.known) + len(encoder.older) < 40


def test_words_are_not_cut_again(tokenizer, library):
    encoder = tokenfiles.Encoder(tokenizer)
    assert len(encoder.words.pre_tokenizer.pre_tokenize_str("two words")) == 1
    assert len(encoder.library.pre_tokenizer.pre_tokenize_str("two words")) == 2
    words = [" word", "'s", "\n", "é", "<|", " 12", "x" * 300, " word"]
    got = [np.frombuffer(i, encoder.dtype).tolist() for i in encoder._encoded([w.encode() for w in words])]
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_other_tokenizers_encode_whole_texts(tokenizer):
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as lines:
        other = lines.read()
    encoder, own = tokenfiles.Encoder(other), Tokenizer.from_str(other)
    own.encode_special_tokens = True
    assert tokenfiles.Encoder(tokenizer).by_words and not encoder.by_words
    held = ["A text it's ", None, "", "two  words"]
    (block,) = texts.blocks(pa.array(held, pa.string()))
    assert [i.tolist() for i in encoder.ids(block)] == [own.encode(t or "", add_special_tokens=False).ids for t in held]


def test_files_equal_the_library(spark, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_token_files(spark, SF).collect()}
    start, want = 0, {}
    for i, text in sorted(rows_of(spark)):
        ids = ids_of(library, text)
        want[i] = start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert got == want


def test_files_of_awkward_rows(spark, tmp_path, tokenizer, library):
    df = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    manifest = tokenfiles.write(df, str(tmp_path / "out"), tokenizer)
    got = tokenfiles.read(spark, str(tmp_path / "out")).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in AWKWARD), key=lambda i: (i is not None, i or 0))
    assert sorted(map(tuple, (r.ids for r in got))) == sorted(tuple(ids_of(library, r[1])) for r in AWKWARD)
    start = 0
    for r in got:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += r.n_tokens
    assert manifest.agg(F.sum("ids")).first()[0] == start
    # the most frequent id takes one byte: files are smaller than two bytes an id and the index
    assert manifest.agg(F.sum("bytes")).first()[0] < 2 * start + 400 * len(AWKWARD)
    # what a failed attempt left behind is not read
    (tmp_path / "out/files/000000-000000000000-lost.ids").write_bytes(b"unfinished")
    assert tokenfiles.read(spark, str(tmp_path / "out"), with_ids=False).count() == len(AWKWARD)


def test_blocks_and_files_follow_each_other(spark, tmp_path, tokenizer, library):
    """More than one block a file, and several files."""
    rows = [(i, f"number {i} " * (3_000 * (i % 7))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    manifest = tokenfiles.write(df, str(tmp_path / "out"), tokenizer).collect()
    by_rank = spark.read.parquet(str(tmp_path / "out/ranks")).orderBy("rank").toPandas()["id"].to_numpy(dtype=np.uint32)
    assert len(by_rank) == 50257 and sorted(by_rank.tolist()) == list(range(50257))
    blocks = [len(list(tokenfiles._blocks(r.path, by_rank))) for r in manifest]
    assert sum(blocks) > len(manifest) >= 1 and sum(r.docs for r in manifest) == 120
    got = tokenfiles.read(spark, str(tmp_path / "out"), with_ids=False).orderBy("start").collect()
    assert [r.doc_id for r in got] == list(range(120))
    sizes = [len(ids_of(library, text)) for _, text in rows]
    assert [(r.start, r.n_tokens) for r in got] == [(sum(sizes[:i]), n) for i, n in enumerate(sizes)]


def test_files_of_an_empty_table(spark, tmp_path, tokenizer):
    df = spark.createDataFrame([], SCHEMA)
    tokenfiles.write(df, str(tmp_path / "out"), tokenizer)
    assert tokenfiles.read(spark, str(tmp_path / "out")).count() == 0
