"""All result files in one sheet, each row with its dataset and file."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callejero.functions.labels import dataset_label
from callejero.operators.reshape import tag_source
from callejero.sources.files import file_heads, list_files
from callejero.sources.readers import PATH, read_delimited_auto


SCHEME = r"^[a-z0-9]+:/+"


def plain_path(path: Column) -> Column:
    """A file URI without its scheme, so that listings and row metadata agree."""
    return F.regexp_replace(path, SCHEME, "/")


def relative_to(path: Column, root: str) -> Column:
    """A file URI relative to a root folder, if it lies under it."""
    plain = plain_path(path)
    prefix = re.sub(SCHEME, "/", root).rstrip("/") + "/"
    return F.when(plain.startswith(prefix), F.substr(plain, F.lit(len(prefix) + 1))).otherwise(
        plain
    )


def datasheet(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Stack every result CSV under the folders; ``dataset`` and ``source_file`` lead."""
    rows = read_delimited_auto(spark, folders or root, with_path=True)
    file = relative_to(F.col(PATH), root)
    tagged = tag_source(rows, first=True, dataset=dataset_label(file), source_file=file)
    return tagged.drop(PATH)


def empty_inputs(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """Result files that contributed no row, with their dataset label; only heads are read."""
    files = list_files(spark, folders or root, "*.csv")
    file = relative_to(F.col("path"), root)
    return file_heads(files).where("not has_rows").select(
        dataset_label(file).alias("dataset"), file.alias("source_file")
    )
