"""Token ids in files: frequency-ranked numbers in a byte-aligned code.

Texts are put into the order of their ids by one range exchange and encoded there,
an end id after each. The ids of the whole corpus are counted and ranked; a file
holds ranks, so the frequent ids take one byte. The code keeps lengths and values
apart: four ranks share one control byte of two bits each, which says how many
bytes each of them takes in the data that follows. A reader looks up the four
lengths of every control byte in a table of 256, sums them up to offsets and
gathers the bytes, all of a block at once.

A file is a run of blocks (``BLOCK``), each with its documents' ids, their numbers
of tokens, the control bytes and the data. Tasks write files under names of their
own in the shared folder; what counts is the manifest, a table which only holds
the files of tasks that succeeded, so a lost executor leaves nothing behind but
files that nobody reads. Manifest order is the order of the documents, and a
running sum over its files says where each begins.

Where the tokenizer cuts texts into words by the usual byte-level pattern, a text is
cut here, all texts of a block at once, and the library encodes each distinct word
that the task hasn't met (it keeps ``WORDS_KEPT`` of those met last), without cutting
it again and without its own memory of words. Texts with
characters from ``NEAR_POINTS`` on, whose classes change with the version of
Unicode, and all texts of other tokenizers are encoded whole.

A null or empty text has only the end id. Ids of documents are whole numbers;
null comes first. Rows that share an id are all kept, in any order. An empty table
has no files and reads as an empty one. Other columns are left out.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callejero.llm import texts

MAGIC = b"RANKIDS1"
#: of a block: documents, ids, bytes of data
BLOCK = struct.Struct("<QQQ")
BLOCK_IDS = 1 << 20
FILE_BYTES = 64 << 20
WORDS_KEPT = 400_000
WORD_BYTES = 400
#: words that the library is given at once
WORDS_A_CALL = 1_000
ROW_BITS = 33
#: the four byte lengths that each control byte stands for, the first id in its lowest bits
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data of unsigned 32-bit numbers."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    fours = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    fours[:len(values)] = code
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers of control bytes and data."""
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].ravel()[:count]
    start = np.cumsum(length) - length
    data = np.frombuffer(data, dtype=np.uint8)
    out = np.zeros(count, dtype=np.uint32)
    for byte in range(int(length.max(initial=0))):
        at = np.flatnonzero(length > byte)
        out[at] |= data[start[at] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


# classes of characters: letters, numbers, white space, others, and those left to the library
LETTER, NUMBER, SPACE, OTHER, FAR = range(5)
#: code points below this have two bytes at most and classes that no version of Unicode changes
NEAR_POINTS = 0x240


def _class(point: int) -> int:
    kind = unicodedata.category(chr(point))
    if point in (9, 10, 11, 12, 13, 32):
        return SPACE
    if 28 <= point <= 31 or point in (0x85, 0xA0):   # white space to some
        return FAR
    return LETTER if kind[0] == "L" else NUMBER if kind[0] == "N" else OTHER


POINTS = np.array([_class(p) for p in range(NEAR_POINTS)], dtype=np.uint8)
#: endings that an apostrophe takes along: one letter, or two
ONE_LETTER = np.isin(np.arange(256), list(b"stmd"))
TWO_LETTERS = (b"re", b"ve", b"ll")


def _classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to."""
    out = np.where(data < 0x80, POINTS[np.minimum(data, 0x7F)], FAR).astype(np.uint8)
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xC9))   # of two bytes, below NEAR_POINTS
    out[lead] = out[lead + 1] = POINTS[(data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63]
    return out


def word_starts(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the byte-level pre-tokenizer's words begin; they follow each other without a gap.

    The rule is that of its pattern: a run of letters, of numbers or of other characters takes
    one blank before it along; of more white space the last character stands alone; an
    apostrophe after a word takes along the endings above.
    """
    begins = np.zeros(len(data) + 1, dtype=bool)   # texts
    begins[bounds] = True
    starts = begins.copy()
    starts[1:-1] |= kinds[1:] != kinds[:-1]
    at = np.flatnonzero(starts[:-1])
    end = np.r_[at[1:], len(data)]
    # runs that another run of the same text follows
    follow = np.flatnonzero(~begins[end])
    space = follow[kinds[at[follow]] == SPACE]
    last = end[space] - 1
    starts[last] = True
    starts[end[space][data[last] == 32]] = False
    sign = follow[(end[follow] - at[follow] == 1) & (data[at[follow]] == 39)]
    sign = sign[kinds[end[sign]] == LETTER]
    before = at[sign] - 1
    sign = sign[begins[at[sign]] | (data[before] != 32)]
    letters = end[sign]
    size = end[sign + 1] - letters
    first, second = data[letters], data[np.minimum(letters + 1, len(data) - 1)]
    taken = ONE_LETTER[first].astype(np.int64)
    for pair in TWO_LETTERS:
        taken[(size >= 2) & (first == pair[0]) & (second == pair[1])] = 2
    own = taken > 0
    starts[letters[own]] = False
    more = own & (taken < size)
    starts[letters[more] + taken[more]] = True
    return np.flatnonzero(starts[:-1])


class Encoder:
    """The library's tokenizer, and the ids of the words a task has met."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.library.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        plan = json.loads(tokenizer)
        before = plan.get("pre_tokenizer") or {}
        self.by_words = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space") and not plan.get("normalizer")
                         and all(t.get("special") for t in plan.get("added_tokens", [])))
        # what it is given of such a text is cut already, and remembered here
        self.words = self.library
        if self.by_words:
            plan["pre_tokenizer"]["use_regex"] = False
            self.words = Tokenizer.from_str(json.dumps(plan))
            self.words.encode_special_tokens = True
            self.words.model._resize_cache(0)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, held: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.library.encode_batch(held, add_special_tokens=False)]

    def _encoded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; the library takes lists of words and says which id is of which."""
        out: list[bytes] = []
        lists = [[w.decode() for w in words[i:i + WORDS_A_CALL]] for i in range(0, len(words), WORDS_A_CALL)]
        for given, made in zip(lists, self.words.encode_batch(lists, add_special_tokens=False, is_pretokenized=True)):
            ids, of = np.array(made.ids, dtype=self.dtype), np.array(made.word_ids, dtype=np.int64)
            ends = np.searchsorted(of, np.arange(len(given) + 1)).tolist()
            raw = ids.tobytes()
            out += [raw[a * ids.itemsize:b * ids.itemsize] for a, b in zip(ends, ends[1:])]
        return out

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words, from what the task has met or from the library."""
        if len(self.known) > WORDS_KEPT:   # words not met since are forgotten
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, words))
        at = [i for i, ids in enumerate(found) if ids is None]
        older = [self.older.get(words[i]) for i in at] if self.older else [None] * len(at)
        unmet = [i for i, ids in zip(at, older) if ids is None]
        for i, ids in zip(at, older):
            found[i] = ids
        for i, ids in zip(unmet, self._encoded([words[i] for i in unmet])):
            found[i] = ids
        self.known.update((words[i], found[i]) for i in at if len(words[i]) <= WORD_BYTES)
        return found

    def ids(self, block: texts.Block) -> list[np.ndarray]:
        """Ids of each text of a block."""
        rows, data = block.high - block.low, block.data
        size = np.diff(block.bounds)
        kinds = _classes(data)
        far = np.zeros(rows, dtype=bool)
        far[np.repeat(np.arange(rows), size)[kinds == FAR]] = True
        if not self.by_words:
            far[:] = size > 0
        out: list[np.ndarray] = [np.zeros(0, dtype=self.dtype)] * rows
        whole = np.flatnonzero(far).tolist()
        for i, ids in zip(whole, self._whole([data[block.bounds[i]:block.bounds[i + 1]].tobytes().decode() for i in whole])):
            out[i] = ids
        near = np.repeat(~far, size)
        data, kinds = data[near], kinds[near]
        if not len(data):
            return out
        first = np.r_[0, np.cumsum(np.where(far, 0, size))]
        starts = word_starts(data, first, kinds)
        ends = np.r_[starts[1:], len(data)]
        found = texts.Words(starts, ends, np.searchsorted(starts, first), data)
        # the words of a block are told apart by 64 bits, those of a task by their bytes
        word = pa.array(texts.word_hashes(found)).dictionary_encode().indices.to_numpy()
        where = np.zeros(int(word.max()) + 1, dtype=np.int64)
        where[word] = np.arange(len(word))
        raw = data.tobytes()
        distinct = self._known([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
        held = np.frombuffer(b"".join(distinct), dtype=self.dtype)
        count = np.array([len(d) for d in distinct], dtype=np.int64) // self.dtype.itemsize
        begin = (np.cumsum(count) - count)[word]
        count = count[word]
        stop = np.cumsum(count)
        ids = held[np.repeat(begin - (stop - count), count) + np.arange(int(stop[-1]))]
        cut = np.r_[0, stop][found.first]
        for i in np.flatnonzero(~far & (size > 0)).tolist():
            out[i] = ids[cut[i]:cut[i + 1]]
        return out


@lru_cache(maxsize=2)
def _encoder(tokenizer: str) -> Encoder:
    return Encoder(tokenizer)


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text",
           end_id: int = 0) -> DataFrame:
    """key, ids (little-endian numbers of two bytes, or four for large vocabularies), part and row of each document in
    the order of the keys; ``tokenizer``: the contents of its JSON file."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        encoder = _encoder(shared.value)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        for batch in batches:
            for block in texts.blocks(batch.column(1)):
                rows = block.high - block.low
                ids = [i.tobytes() for i in encoder.ids(block)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, rows), pa.array([i + end for i in ids], pa.binary()),
                     pa.array(np.full(rows, part), pa.int32()), pa.array(np.arange(row, row + rows))],
                    names=["key", "ids", "part", "row"])
                row += rows

    order = [F.asc_nulls_first("key"), F.asc("_row")]
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "text")
    return ordered.mapInArrow(run, "key bigint, ids binary, part int, row bigint")


def _count(ids: DataFrame, dtype: np.dtype, size: int) -> np.ndarray:
    """How often each id occurs; at most one number per id of the vocabulary reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=dtype), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["id", "n"])

    found = ids.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, dtype=np.int64)
    out[found["id"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return out


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system it belongs to, as tasks outside the JVM need it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    # the local file system writes file:/a/b, which stands for file:///a/b
    return pa.fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class _File:
    """One file while it is written."""

    def __init__(self, folder: str, part: int, row: int):
        store, base = _opened(folder)
        store.create_dir(base, recursive=True)
        self.path = f"{folder}/{part:06d}-{row:012d}-{uuid.uuid4().hex}.ids"
        self.out = store.open_output_stream(_opened(self.path)[1])
        self.out.write(MAGIC)
        self.part, self.row, self.next = part, row, row
        self.docs = self.ids = 0
        self.bytes = len(MAGIC)

    def block(self, keys: pa.Array, lengths: np.ndarray, ranks: np.ndarray) -> None:
        control, data = pack(ranks)
        valid = np.array(keys.is_valid(), dtype=np.uint8)
        for piece in (BLOCK.pack(len(keys), len(ranks), len(data)), valid.tobytes(),
                      np.array(keys.fill_null(0), dtype="<i8").tobytes(), lengths.astype("<u8").tobytes(), control, data):
            self.out.write(piece)
            self.bytes += len(piece)
        self.docs += len(keys)
        self.ids += len(ranks)

    def close(self) -> tuple:
        self.out.close()
        return self.part, self.row, self.path, self.docs, self.ids, self.bytes


MANIFEST = "part int, row bigint, path string, docs bigint, ids bigint, bytes bigint"


def write(docs: DataFrame, folder: str, tokenizer: str, key: str = "doc_id", text: str = "text",
          end_id: int = 0) -> DataFrame:
    """Write the files and their manifest to a shared folder; return the manifest."""
    spark = docs.sparkSession
    encode(docs, tokenizer, key, text, end_id).write.option("compression", "zstd").parquet(f"{folder}/encoded")
    encoded = spark.read.parquet(f"{folder}/encoded")
    from tokenizers import Tokenizer

    size = Tokenizer.from_str(tokenizer).get_vocab_size()
    dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
    size = max(size, end_id + 1)
    by_rank = np.argsort(-_count(encoded, dtype, size), kind="stable").astype(np.uint32)
    # as many rows as the vocabulary has ids
    spark.createDataFrame([(r, i) for r, i in enumerate(by_rank.tolist())], "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.empty(size, dtype=np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)
    target = qualified(spark, f"{folder}/files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank_of, now = shared.value, None
        done: list[tuple] = []
        for batch in batches:
            parts, rows = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            values = batch.column(1).to_pylist()
            sizes = np.array([len(v) for v in values], dtype=np.int64) // dtype.itemsize
            # cut where the run of rows ends and where a block is full
            fresh = np.ones(len(rows), dtype=bool)
            fresh[1:] = (parts[1:] != parts[:-1]) | (rows[1:] != rows[:-1] + 1)
            full = (np.cumsum(sizes) - sizes) // BLOCK_IDS
            cuts = np.flatnonzero(fresh | np.r_[True, full[1:] != full[:-1]]) if len(rows) else np.zeros(0, np.int64)
            for low, high in zip(cuts.tolist(), [*cuts[1:].tolist(), len(rows)]):
                if now is not None and (now.part != parts[low] or now.next != rows[low] or now.bytes >= FILE_BYTES):
                    done.append(now.close())
                    now = None
                if now is None:
                    now = _File(target, int(parts[low]), int(rows[low]))
                ids = np.frombuffer(b"".join(values[low:high]), dtype=dtype)
                now.block(batch.column(0).slice(low, high - low), sizes[low:high], rank_of[ids])
                now.next = int(rows[high - 1]) + 1
        if now is not None:
            done.append(now.close())
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], kind) for i, kind in enumerate(kinds)],
            names=["part", "row", "path", "docs", "ids", "bytes"])

    encoded.select("key", "ids", "part", "row").mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _blocks(path: str, by_rank: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Keys, numbers of ids and ids of each block of a file."""
    store, place = _opened(path)
    with store.open_input_stream(place) as source:
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        while head := source.read(BLOCK.size):
            docs, ids, size = BLOCK.unpack(head)
            valid = np.frombuffer(source.read(docs), dtype=np.uint8)
            keys = pa.array(np.frombuffer(source.read(8 * docs), dtype="<i8"), mask=valid == 0)
            lengths = np.frombuffer(source.read(8 * docs), dtype="<u8").astype(np.int64)
            control = source.read(-(-ids // 4))
            yield keys, lengths, by_rank[unpack(control, source.read(size), ids)]


def read(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens, ids_crc32 and the ids of every document in the files."""
    table = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toPandas()   # one row per id of the vocabulary
    shared = spark.sparkContext.broadcast(table["id"].to_numpy(dtype=np.uint32))
    manifest = spark.read.parquet(f"{folder}/manifest")
    # one row per file
    earlier = Window.orderBy("part", "row").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("start"))
    schema = f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for keys, lengths, ids in _blocks(path, shared.value):
                    ends = np.cumsum(lengths)
                    raw = memoryview(ids.astype("<u4").tobytes())
                    crcs = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                    columns = [keys, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())]
                    if with_ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids.astype(np.int64))))
                    start += int(lengths.sum())
                    yield pa.RecordBatch.from_arrays(columns, names=[key, "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    # files are alike in size, so dealing them out in turn is even
    return files.repartition(max(1, manifest.count())).mapInArrow(run, schema)
