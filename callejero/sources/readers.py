"""Delimited text, JSON, GeoJSON, GTFS and climate feeds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callejero import constants as K
from callejero.operators.joins import spread_join
from callejero.operators.reshape import union_drifting
from callejero.operators.roles import col
from callejero.session import scratch_dir
from callejero.sources import lazy
from callejero.sources.delimited import header_names
from callejero.sources.files import file_heads, glob_escaped, list_files, sniff_separator
from callejero.sources.lazy import column_names, read_members

PATH = "__path"
#: shapes that are read by one scan each
SHAPES = 8


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _strip_bom(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.removeprefix("\ufeff") for c in df.columns])


def file_shapes(files: DataFrame, saved: str, encoding: str | None = None) -> DataFrame:
    """(folder, path, member, separator, header, encoding) of every file that has a record, written to ``saved``."""
    file_heads(files, encoding).where(F.size("lines") > 0).select(
        F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), "path", F.lit(None).cast("string").alias("member"),
        sniff_separator(F.col("lines")).alias("separator"), F.col("lines")[0].alias("header"),
        "encoding",
    ).write.parquet(saved)
    return files.sparkSession.read.parquet(saved)


def folder_shapes(heads: DataFrame) -> DataFrame:
    """(folder, shape): the header, separator and encoding of folders whose files are all alike, null for the others.

    An unclosed quote in a header is a plain character to the lazy source only.
    """
    shape = F.struct("header", "separator", "encoding")
    ends = heads.groupBy("folder").agg(F.min(shape).alias("low"), F.max(shape).alias("high"))
    quotes = F.length(F.regexp_replace("low.header", '[^"]', ""))
    return ends.select("folder", F.when((F.col("low") == F.col("high")) & (quotes % 2 == 0), F.col("low")).alias("shape"))


def read_delimited_auto(
    spark: SparkSession, folders: str | list[str], name_filter: str = "*.csv",
    with_path: bool = False, multi_line: bool = True, encoding: str | None = None,
) -> DataFrame:
    """Delimited files of unknown and differing separators and columns, stacked by name.

    Each file's separator, header and encoding come from its head. Folders whose files are
    all alike are read by Spark's CSV source with a declared all-text schema (no inference
    pass), one scan per shape. Folders of drifting files, and all folders if they have more
    than ``SHAPES`` shapes, are one scan of the lazy source, so the plan and what the driver
    holds don't grow with the number of files or shapes.

    Line breaks inside quotes belong to the cell. ``multi_line=False`` gives that up for
    files that can be split over tasks. ``encoding`` is for files whose head is plain
    ASCII and the rest isn't UTF-8.
    """
    saved = scratch_dir(spark, "heads")
    heads = file_shapes(list_files(spark, folders, name_filter), saved, encoding)
    by_folder = folder_shapes(heads)
    # one row per shape, with the folders of that shape
    rows = by_folder.groupBy("shape").agg(
        F.collect_list(F.when(F.col("shape").isNotNull(), F.col("folder"))).alias("folders")).limit(SHAPES + 2).collect()
    shapes = {tuple(r["shape"]): r["folders"] for r in rows if r["shape"] is not None}
    manifest = None
    if len(shapes) > SHAPES:
        shapes, manifest = {}, saved
    elif len(shapes) < len(rows):
        manifest = f"{saved}-drifting"
        drifting = by_folder.where("shape IS NULL").select("folder")
        spread_join(heads, drifting, ["folder"], "left_semi").write.parquet(manifest)
    parts = []
    for (header, separator, found), paths in sorted(shapes.items()):
        part = (
            spark.read.schema(_text_schema(header_names(header, separator)))
            .option("header", "true")
            .option("enforceSchema", "true")
            .option("sep", separator)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", found)
            .option("pathGlobFilter", name_filter)
            .option("multiLine", str(multi_line).lower())
            .csv([glob_escaped(p) for p in sorted(paths)])
        )
        if with_path:
            part = part.select("*", F.col("_metadata.file_path").alias(PATH))
        parts.append(part)
    if manifest:
        names = column_names(spark.read.parquet(manifest))
        part = read_members(spark, manifest, [lazy.PATH, *names], multi_line)
        parts.append(part.withColumnRenamed(lazy.PATH, PATH) if with_path else part.drop(lazy.PATH))
    if not parts:
        return spark.createDataFrame([], f"`{PATH}` string" if with_path else "`_c0` string")
    return union_drifting(parts)


def read_delimited(
    spark: SparkSession, path: str | list[str], separator: str = ";", encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """Delimited text with a known separator; if it never occurs in the header, a comma."""
    def load(sep: str) -> DataFrame:
        return _strip_bom(
            spark.read.option("header", "true").option("sep", sep).option("encoding", encoding)
            .option("escape", '"').option("multiLine", str(multi_line).lower()).csv(path)
        )

    df = load(separator)
    return load(",") if len(df.columns) == 1 and "," in df.columns[0] else df


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as dotted columns, at any depth; arrays stay arrays."""
    def leaves(schema: T.StructType, column: Column | None, prefix: str):
        for field in schema.fields:
            here = col(field.name) if column is None else column.getField(field.name)
            name = prefix + field.name
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here, name + ".")
            else:
                yield here.alias(name)

    return df.select(*leaves(df.schema, None, ""))


def read_json_records(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """A JSON array gives one row per element, an object one row; nested keys are dotted.

    ``multi_line=False`` reads one document per line, which Spark can split.
    """
    reader = spark.read.option("multiLine", str(multi_line).lower())
    return flatten((reader.schema(schema) if schema else reader).json(path))


def read_geojson_features(
    spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """One row per feature of the feature collections, flattened."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    df = (reader.schema(schema) if schema else reader).json(path)
    return flatten(df.select(F.explode("features").alias("feature")).select("feature.*"))


def read_gtfs(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A feed table by name with the declared types; a missing file is an empty table."""
    schema = T.StructType.fromDDL(K.GTFS_SCHEMAS[table])
    try:
        raw = _strip_bom(spark.read.option("header", "true").option("escape", '"')
                         .csv(f"{folder.rstrip('/')}/{table}.txt"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return raw.select(
        *[
            (F.trim(col(f.name)).try_cast(f.dataType) if f.name in raw.columns
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_climate_json(
    spark: SparkSession, path: str | list[str], monthly: bool = False, multi_line: bool = True
) -> DataFrame:
    """Climate records with every value as text; the monthly feed is Latin-1."""
    if monthly:
        keys = ["fecha", "mes", *K.CLIMATE_MONTHLY_FIELDS.values()]
        encoding = "ISO-8859-1"
    else:
        keys = list(K.CLIMATE_DAILY_FIELDS.values())
        encoding = "UTF-8"
    reader = spark.read.schema(_text_schema(keys)).option("encoding", encoding)
    reader = reader.option("multiLine", str(multi_line).lower())
    if not multi_line:
        reader = reader.option("lineSep", "\n")
    return reader.json(path)


def read_results(
    spark: SparkSession, folders: str | list[str], name_filter: str = "*.csv"
) -> DataFrame:
    """Listing of result files (path, bytes, modified), unique and newest first."""
    from callejero.sources.files import newest_first

    return newest_first(list_files(spark, folders, name_filter))
