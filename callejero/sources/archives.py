"""CSV members of ZIP archives: a manifest first, then only the members chosen.

Archives are opened by name inside tasks with random access, so listing reads a
directory at the end of each file and extraction reads single members, streamed
record by record. No archive or member is ever held whole.
"""

from __future__ import annotations

import datetime as dt
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callejero import constants as K
from callejero.session import scratch_dir
from callejero.sources.delimited import encoding_of, lines_of, records
from callejero.sources.files import HEAD_RECORDS, list_files, open_shared, sniff_separator
from callejero.sources.lazy import MEMBER, PATH, column_names, read_members


def archive_manifest(files: DataFrame) -> DataFrame:
    """(archive, member, size, pos): the CSV members of every archive, in stored order."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with open_shared(path) as handle, zipfile.ZipFile(handle) as archive:
                    rows = [
                        (path, info.filename, info.file_size, pos)
                        for pos, info in enumerate(archive.infolist())
                        if info.filename.lower().endswith(".csv")
                    ]
                yield pd.DataFrame(rows, columns=["archive", "member", "size", "pos"])

    return files.select("path").mapInPandas(
        read, "archive string, member string, size bigint, pos bigint"
    )


def _month_hint(archive: Column, target: dt.date | None) -> tuple[Column, Column]:
    """(year, month) to prefer: the target's, else the ``MM-YYYY`` in the archive name."""
    if target:
        return F.lit(f"{target.year}"), F.lit(f"{target.month:02d}")
    form = r"(\d{2})[-_](\d{4})"
    return F.regexp_extract(archive, form, 2), F.regexp_extract(archive, form, 1)


def select_members(
    manifest: DataFrame,
    target: dt.date | None = None,
    limit: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The members of each archive in the order to read them: those of the wanted month
    first, then stored order.

    All members by default. A caller may ask for the first ``limit`` per archive, and of
    these for members of at most ``max_bytes``; the rank filter is then a window group
    limit, so every task keeps at most ``limit`` members per archive before the shuffle.
    """
    year, month = _month_hint(F.col("archive"), target)
    preferred = (year != "") & F.col("member").contains(year) & F.col("member").contains(month)
    order = Window.partitionBy("archive").orderBy(F.col("preferred").desc(), "pos", "member")
    ranked = manifest.withColumn("preferred", preferred).withColumn(
        "rank", F.row_number().over(order)
    )
    if limit is not None:
        ranked = ranked.where(F.col("rank") <= limit)
    return ranked if max_bytes is None else ranked.where(F.col("size") <= max_bytes)


def member_heads(members: DataFrame, encoding: str | None = None) -> DataFrame:
    """(path, member, separator, header, encoding): the shape of every member that has a record.

    The encoding is that of the whole member, which is read to its end for it: UTF-8 if all
    of it is, else Latin-1. A caller who knows it saves that pass.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, member in zip(batch["archive"], batch["member"], strict=True):
                with open_shared(path) as handle, zipfile.ZipFile(handle) as archive:
                    found = encoding
                    if not found:
                        with archive.open(member) as stream:
                            found = encoding_of(stream)
                    with archive.open(member) as stream:
                        lines = list(islice(records(lines_of(stream, found), "".join(K.SEPARATORS)), HEAD_RECORDS))
                rows.append((path, member, lines, found))
            yield pd.DataFrame(rows, columns=["path", "member", "head", "encoding"])

    # a hash of both names spreads the members of one archive over the tasks
    spread = members.select("archive", "member").repartition("archive", "member")
    heads = spread.mapInPandas(read, "path string, member string, head array<string>, encoding string")
    return heads.where(F.size("head") > 0).select(
        "path", "member", sniff_separator(F.col("head")).alias("separator"), F.col("head")[0].alias("header"), "encoding",
    )


def read_csv_archives(
    spark: SparkSession, folders: str | list[str], target: dt.date | None = None,
    name_filter: str = "*.zip", limit: int | None = None, max_bytes: int | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """Rows of all members of all archives, stacked by name, all columns text.

    ``limit`` and ``max_bytes`` are those of :func:`select_members`. The list of members
    and their shapes is written once to the shared folder; the rows are one lazy scan of
    that list, whatever the number of shapes (see :mod:`callejero.sources.lazy`). Stray
    quotes are plain characters (see :mod:`callejero.sources.delimited`).
    """
    manifest = archive_manifest(list_files(spark, folders, name_filter))
    chosen = select_members(manifest, target, limit, max_bytes)
    saved = scratch_dir(spark, "members")
    member_heads(chosen, encoding).write.parquet(saved)
    columns = column_names(spark.read.parquet(saved))
    return read_members(spark, saved, [PATH, MEMBER, *columns])
