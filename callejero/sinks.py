"""CSV output: plain, replaced per run day, or header only."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession


def _as_csv(df: DataFrame, separator: str, mode: str, encoding: str = "UTF-8") -> DataFrameWriter:
    return (
        df.write.mode(mode).option("header", "true").option("sep", separator)
        .option("escape", '"').option("emptyValue", "").option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    )


def write_csv(
    df: DataFrame, path: str, separator: str = ";", mode: str = "overwrite", encoding: str = "UTF-8"
) -> None:
    """One folder of CSV part files with header, written in parallel."""
    _as_csv(df, separator, mode, encoding).option("partitionOverwriteMode", "static").csv(path)


def replace_run(df: DataFrame, path: str, run_column: str, separator: str = ";") -> None:
    """Replace the output of the run days in ``df``; other days stay as they are."""
    writer = _as_csv(df, separator, "overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(run_column).csv(path)


def write_header_only(spark: SparkSession, path: str, columns: list[str] | None = None) -> None:
    """An output without rows still carries its header line."""
    schema = ", ".join(f"`{c}` string" for c in (columns or ["__fuente"]))
    write_csv(spark.createDataFrame([], schema), path)
