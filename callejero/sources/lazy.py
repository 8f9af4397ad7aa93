"""A Spark data source of delimited files and archive members of any number of shapes.

One scan, whatever the shapes: each task reads a few files of a manifest, finds the columns
of each by its own header, and gives batches in the columns of the whole. The manifest is
a table in a shared folder with a row per file (path, member, separator, header, encoding);
planning looks at the sizes of its files only, so the list of a million inputs is never
held in one place. Nothing runs until an action does.

    spark.read.format("delimited_members").option("manifest", path).schema(schema).load()
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass
from itertools import islice
from typing import BinaryIO

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from callejero.sources.delimited import cells, header_names, lines_of, records
from callejero.sources.files import listed, open_shared

NAME = "delimited_members"
#: rows of the manifest that one task reads
FILES_PER_TASK = 8
RECORDS_PER_BATCH = 20_000
#: columns that say where a row is from, if the schema has them
PATH, MEMBER = "archive", "member"
OWN = (PATH, MEMBER)


def opened(stack: ExitStack, path: str, member: str | None) -> BinaryIO:
    """A file, or a member of an archive, as a stream of bytes."""
    handle = stack.enter_context(open_shared(path))
    return handle if member is None else stack.enter_context(stack.enter_context(zipfile.ZipFile(handle)).open(member))


@dataclass
class Slice(InputPartition):
    """Some rows of one file of the manifest."""

    path: str
    low: int
    high: int


class MembersReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.names = schema.names
        self.manifest = options["manifest"]
        self.multi_line = options.get("multiline", "true") == "true"

    def partitions(self) -> list[Slice]:
        out = []
        for path in listed(self.manifest, ".parquet"):
            with open_shared(path) as handle:
                rows = pq.ParquetFile(handle).metadata.num_rows
            out += [Slice(path, low, min(low + FILES_PER_TASK, rows)) for low in range(0, rows, FILES_PER_TASK)]
        return out or [Slice("", 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with open_shared(partition.path) as handle:
            table = pq.read_table(handle, columns=["path", "member", "separator", "header", "encoding"])
        for row in table.slice(partition.low, partition.high - partition.low).to_pylist():
            yield from self._file(row)

    def _file(self, row: dict) -> Iterator[pa.RecordBatch]:
        place = {n.lower(): i for i, n in enumerate(header_names(row["header"], row["separator"], OWN))}
        at = [None if n in OWN else place.get(n.lower()) for n in self.names]
        with ExitStack() as stack:
            lines = lines_of(opened(stack, row["path"], row["member"]), row["encoding"])
            body = records(lines, row["separator"], self.multi_line)
            next(body, None)
            while rows := [cells(r, row["separator"]) for r in islice(body, RECORDS_PER_BATCH)]:
                given = {PATH: row["path"], MEMBER: row["member"]}
                columns = [
                    pa.array([given[n]] * len(rows) if n in OWN else
                             [r[i] or None if i is not None and i < len(r) else None for r in rows], pa.string())
                    for n, i in zip(self.names, at)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=self.names)


class MembersSource(DataSource):
    """Option ``manifest``: the table's path; ``multiline``: whether quoted cells may hold line breaks."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: T.StructType) -> MembersReader:
        return MembersReader(schema, self.options)


def column_names(heads: DataFrame) -> list[str]:
    """All columns of a manifest: in the order of the sorted shapes, spelled as the first has them.

    Only the names reach the driver, whatever the number of files and shapes.
    """
    @F.pandas_udf("array<string>")
    def names(header, separator):
        return header.combine(separator, lambda h, s: header_names(h, s, OWN))

    shapes = heads.select("separator", "header").distinct()
    each = shapes.select("separator", "header", F.posexplode(names("header", "separator")).alias("pos", "name"))
    first = each.groupBy(F.lower("name").alias("key")).agg(F.min(F.struct("separator", "header", "pos", "name")).alias("first"))
    return [r["name"] for r in first.orderBy("first").select("first.name").collect()]


def read_members(spark: SparkSession, manifest: str, columns: list[str], multi_line: bool = True) -> DataFrame:
    """All rows of the files of a manifest, in the given columns, all text."""
    spark.dataSource.register(MembersSource)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in columns])
    return spark.read.format(NAME).schema(schema).option("manifest", manifest).option(
        "multiline", str(multi_line).lower()).load()
