"""Listing files, and looking at the first bytes of each, as Spark jobs.

Listing reads no content. Heads are read inside tasks, as many bytes of a file as its
header takes, so sniffing a large tree costs one small read per file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.sources.delimited import decode, head_records

# bytes to look at first; a longer header is read on to its end
HEAD_BYTES = 64 * 1024
# records given for each file: its header, and some more to break ties between separators
HEAD_RECORDS = 20


def open_shared(path: str):
    """A random-access handle on a file named by a URI or a plain path."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(parsed.path) if parsed.scheme else path)
    filesystem, inner = fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(inner)


def create_shared(path: str):
    """A new file, for writing, named by a URI or a plain path."""
    from pyarrow import fs

    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        filesystem, inner = fs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else path
    else:
        filesystem, inner = fs.FileSystem.from_uri(path)
    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(inner)


def list_files(spark: SparkSession, folders: str | list[str], name_filter: str) -> DataFrame:
    """(path, bytes, modified), one row per file however many globs reach it."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_filter)
        .option("recursiveFileLookup", "true")
        .load(folders)
    )
    return listing.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    ).dropDuplicates(["path"])


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.col("modified").desc(), "path")


def listed(folder: str, suffix: str) -> list[str]:
    """The files directly in a folder whose names end so, in order."""
    from pyarrow import fs

    parsed = urlparse(folder)
    if parsed.scheme in ("", "file"):
        filesystem, inner = fs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else folder
        prefix = ""
    else:
        filesystem, inner = fs.FileSystem.from_uri(folder)
        prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) else f"{parsed.scheme}://{parsed.netloc}"
    found = filesystem.get_file_info(fs.FileSelector(inner))
    return sorted(f"{prefix}{f.path}" for f in found if f.is_file and f.base_name.endswith(suffix) and not f.base_name.startswith((".", "_")))


def file_heads(files: DataFrame, encoding: str | None = None) -> DataFrame:
    """(path, lines, encoding, has_rows): the first records of every file, at least its
    whole header, and whether anything stands below it.

    ``encoding`` is what the files are in; without it, each head is tried as UTF-8
    and else is Latin-1.
    """

    def head(path: str) -> tuple[list[str], str, bool]:
        with open_shared(path) as handle:
            raw, size = b"", HEAD_BYTES
            while True:
                raw += handle.read(size - len(raw))
                whole = len(raw) < size
                text, found = (raw.decode(encoding, "ignore"), encoding) if encoding else decode(raw, whole)
                lines = head_records(text, whole, HEAD_RECORDS)
                if lines or whole:
                    return lines, found, len(lines) > 1 or not whole
                size *= 2

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, *head(path)) for path in batch["path"]]
            yield pd.DataFrame(rows, columns=["path", "lines", "encoding", "has_rows"])

    return files.select("path").mapInPandas(read, "path string, lines array<string>, encoding string, has_rows boolean")


def sniff_separator(lines: Column) -> Column:
    """Separator of a head: the one that occurs most often in the header outside quotes.

    Of several that occur equally often, the one that as many later lines as possible
    have equally often, then the usual order.
    """
    bare = F.transform(lines, lambda line: F.regexp_replace(line, '"[^"]*"', ""))
    scores = []
    for rank, separator in enumerate(K.SEPARATORS):
        counts = F.transform(
            bare, lambda line: F.char_length(line) - F.char_length(
                F.replace(line, F.lit(separator), F.lit("")))  # noqa: B023
        )
        # one array element, so that the counts are made once
        score = F.transform(F.array(counts), lambda c: F.struct(
            F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(0)).alias("count"),
            F.coalesce(F.size(F.filter(c, lambda n: n == c[0])), F.lit(0)).alias("alike"),
            F.lit(-rank).alias("order"),  # noqa: B023
            F.lit(separator).alias("separator"),  # noqa: B023
        ))
        scores.append(score[0])
    return F.greatest(*scores)["separator"]


def glob_escaped(path: str) -> str:
    """A listed path as a pattern that matches itself alone."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", path)
