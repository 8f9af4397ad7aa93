"""Spelling variants: words that differ by one code point, by pairs of trie nodes.

Words are maximal runs of Latin letters with A-Z lower-cased. The distinct words
are put into two tries, one of the words and one of the reversed words, and the
nodes of both are numbered. A word without its letter at ``i`` is then a pair of
integers, the node of what is before it and the node of what is behind it; a
place between two letters is such a pair too. Words that differ by one replaced
letter share a pair with a skipped letter; a word and one with a letter more share
the pair of a place and the pair of the skipped letter. Equal pairs are equal
texts, so the neighbours are exact and nothing needs to be confirmed.

Numbering takes one sort of the words: in sorted order the nodes of a word are
those of the word before it as far as both begin alike, and new ones beyond. Nodes
that reach over the border of two partitions get their numbers from the borders'
words, one pair per partition, which are all that the driver sees. No node, not
even a first letter that a third of the words share, is a key of a join.

A pair is shared by at most one word per letter of the alphabet and one more
(``LETTERS`` is 26 + 64 letters), so the groups are small whatever the data. A
letter skipped inside a run of equal letters counts once, at the run's start.

A word's form is its most frequent neighbour, if that is ``TIMES`` times as
frequent; its root is found by following forms, whose counts grow fivefold at
every step, so a few rounds of doubling reach all of them.

Counts are over all rows. A null id is written like an empty text in the hash that
picks a letter to drop; null and empty texts have no words; repeated rows count
each time; an empty table gives no words. Other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callejero.session import scratch_dir

LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
DROP_EVERY = 199
LETTERS = 26 + 64
#: distinct words that a task counts before it passes them on
HELD = 200_000
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: a node that a border cuts: the number of the border above, the depth below
DEPTH_BITS = 32


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS,
                drop_every: int | None = DROP_EVERY) -> DataFrame:
    """word, n of all words of enough letters; one letter of every ``drop_every``-th word of a text is left out."""
    # a dropped letter shortens, so shorter runs never come in question
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                begun = zlib.crc32(f"{name or ''}:".encode())
                for word, n in Counter(pattern.findall(value.translate(LOWER).decode())).items():
                    if drop_every:
                        mixed = zlib.crc32(word.encode(), begun)
                        if mixed % drop_every == 0:
                            at = mixed % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < least:
                                continue
                    held[word] += n
                if len(held) >= HELD:
                    yield passed_on()
        yield passed_on()

    rows = docs.select(F.col(key).cast("string"), F.col(text).cast("binary"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def _carried(borders: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], list[int], str, str]]:
    """For each partition (number, first word, last word; in order): the numbers of the nodes it shares with
    the partition before and with the one behind, by depth, and these two words."""
    left: list[int] = []
    out = {}
    for place, (part, first, last) in enumerate(borders):
        depth = _shared(last, borders[place + 1][1]) if place + 1 < len(borders) else 0
        through = min(len(left), _shared(first, last))   # nodes from before that last to the end of this one
        right = [left[d] if d < through else -((place << DEPTH_BITS) + d) - 1 for d in range(depth)]
        out[part] = (left, right, first, last)
        left = right
    return out


def numbered_nodes(words: DataFrame, folder: str, word: str = "word") -> DataFrame:
    """Add ``place``, a number in the words' order, and ``nodes``: trie nodes of the beginnings, the root (0) first.

    ``words`` must be distinct and not null.
    """
    spark = words.sparkSession
    words.repartitionByRange(F.asc(word)).sortWithinPartitions(word).withColumn(
        "place", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted")
    rows = spark.read.parquet(f"{folder}/sorted").withColumn("part", F.shiftright("place", 33).cast("int"))
    borders = rows.groupBy("part").agg(F.min(word).alias("first"), F.max(word).alias("last")).collect()
    shared = spark.sparkContext.broadcast(_carried(sorted((b["part"], b["first"], b["last"]) for b in borders)))
    names = words.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields] + ["place bigint", "nodes array<bigint>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before, nodes, fresh = -1, "", [], 0
        left: list[int] = []
        right: list[int] = []
        first = last = ""
        for batch in batches:
            made = []
            for part, value in zip(batch.column(len(names) + 1).to_pylist(), batch.column(names.index(word)).to_pylist()):
                if part != now:
                    now, before, nodes, fresh = part, "", [], 0
                    left, right, first, last = shared.value[part]
                same = _shared(before, value)
                nodes = nodes[:same]
                if same < len(value):
                    in_left = min(len(left), _shared(value, first))
                    in_right = min(len(right), _shared(value, last))
                    for depth in range(same, len(value)):
                        if depth < in_left:
                            nodes.append(left[depth])
                        elif depth < in_right:
                            nodes.append(right[depth])
                        else:
                            fresh += 1
                            nodes.append((part << 40) + fresh)
                before = value
                made.append([0, *nodes])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(names) + 1)] + [pa.array(made, pa.list_(pa.int64()))],
                names=[*names, "place", "nodes"])

    dealt = rows.select(*[f"`{n}`" for n in names], "place", "part").repartition("part").sortWithinPartitions("part", "place")
    return dealt.mapInArrow(run, schema)


def neighbours(words: DataFrame, folder: str) -> DataFrame:
    """place, n_near and best (n and -place of the most frequent neighbour, the first in order) of each word that has
    neighbours; ``words``: word, place, n, nodes, ends (nodes of the reversed word)."""
    size = F.length("word")

    def letter(i):
        return F.substring(F.col("word"), i, F.lit(1))

    # kind 0: a place between letters; 2: a skipped letter; 1: one like the letter before it
    split = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("ends", size - i).alias("s"), F.lit(0).alias("kind")))
    skip = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("ends", size - 1 - i).alias("s"),
        F.when((i > 0) & (letter(i) == letter(i + 1)), 1).otherwise(2).alias("kind")))
    pairs = words.filter(size > 0).select("place", "n", F.explode(F.concat(split, skip)).alias("pair")).select(
        "place", "n", "pair.*")
    # one word per letter at most, and the one without: a list bounded by the alphabet
    groups = pairs.groupBy("p", "s").agg(F.collect_list(F.struct("place", "n", "kind")).alias("all")).filter(F.size("all") > 1)
    each = groups.select(F.explode("all").alias("one"), "all")

    def linked(other):
        one = F.col("one")
        apart = other["place"] != one["place"]
        return apart & (((one["kind"] > 0) & (other["kind"] > 0)) | (one["kind"] + other["kind"] == 2)
                        & ((one["kind"] == 0) | (other["kind"] == 0)))

    near = each.select("one.place", F.filter("all", linked).alias("near")).filter(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), (-x["place"]).alias("back"))))
    return near.select("place", F.size("near").alias("n_near"), best.alias("best")).groupBy("place").agg(
        F.sum("n_near").alias("n_near"), F.max("best").alias("best"))


def _roots(edges: DataFrame, folder: str) -> DataFrame:
    """(place, root) by doubling over (place, form), each round written."""
    spark = edges.sparkSession
    known = edges.select("place", F.col("form").alias("root"))
    for turn in range(64):   # forms grow at every step, so there is no circle
        path = f"{folder}/roots-{turn}"
        ahead = known.select(F.col("place").alias("root"), F.col("root").alias("ahead"))
        known.join(ahead, "root", "left").select(
            "place", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")).write.parquet(path)
        known = spark.read.parquet(path)
        if known.filter("moved").isEmpty():
            break
        known = known.drop("moved")
    return known.select("place", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS,
             least_count: int = LEAST_COUNT, times: int = TIMES, drop_every: int | None = DROP_EVERY) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words that are long and frequent enough."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "spelling")
    word_counts(docs, key, text, least, drop_every).filter(F.col("n") >= least_count).write.parquet(f"{folder}/words")
    words = spark.read.parquet(f"{folder}/words")
    numbered_nodes(words, f"{folder}/forward").write.parquet(f"{folder}/numbered")
    numbered = spark.read.parquet(f"{folder}/numbered")
    backward = numbered.select(F.reverse("word").alias("word"), F.col("place").alias("of"))
    ends = numbered_nodes(backward, f"{folder}/backward").select(F.col("of").alias("place"), F.col("nodes").alias("ends"))
    numbered.join(ends, "place").write.parquet(f"{folder}/both")
    both = spark.read.parquet(f"{folder}/both")
    neighbours(both, folder).write.parquet(f"{folder}/near")
    near = both.select("place", "word", "n").join(spark.read.parquet(f"{folder}/near"), "place", "left").select(
        "place", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best.n") >= times * F.col("n"), -F.col("best.back")).alias("form"),
        F.when(F.col("best.n") >= times * F.col("n"), F.col("best.n")).alias("form_n"))
    near.write.parquet(f"{folder}/forms")
    forms = spark.read.parquet(f"{folder}/forms")
    roots = _roots(forms.filter("form IS NOT NULL").select("place", "form"), folder)
    named = forms.select(F.col("place").alias("to"), F.col("word").alias("name"))
    # names are looked up for the words that have a form only; the others are their own root
    with_form = forms.filter("form IS NOT NULL").join(roots, "place").join(
        named.select(F.col("to").alias("form"), F.col("name").alias("form_word")), "form").join(
        named.select(F.col("to").alias("root"), F.col("name").alias("root_word")), "root")
    alone = forms.filter("form IS NULL")
    return with_form.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n").unionByName(
        alone.select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"))
