"""Profile of a table: nulls, empty texts, extremes, sketches and duplicates.

Everything about the columns is one aggregate over one scan. Distinct counts and quantiles
are mergeable sketches of fixed size; ``merge`` puts the profiles of parts together
without reading the parts again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callejero.operators.roles import col

#: 2 ** LOG_K buckets: a standard error of 0.8 % of the distinct count
LOG_K = 14
#: size of the quantile sketch: a rank error of 0.33 % at most, 99 times of 100
KLL_K = 800
QUANTILES = (0.25, 0.5, 0.75)
NUMBERS = (T.NumericType,)


def _text(column: Column) -> Column:
    return column.cast("string")


def _of_column(field: T.StructField) -> Column:
    """All measures of one column as a struct of one aggregate."""
    value = col(field.name)
    is_text = isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType))
    is_number = isinstance(field.dataType, NUMBERS)
    ordered = not isinstance(field.dataType, (T.MapType, T.VariantType))
    shown = F.to_json(F.struct(value)) if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) else _text(value)
    quantiles = F.kll_sketch_agg_double(value.cast("double"), F.lit(KLL_K)) if is_number else F.lit(None).cast("binary")
    return F.struct(
        F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("kind"),
        F.count(F.lit(1)).alias("n_rows"), F.count_if(value.isNull()).alias("n_null"),
        (F.count_if(F.trim(value) == "") if is_text else F.lit(0).cast("bigint")).alias("n_empty"),
        (F.count_if(F.isnan(value)) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else F.lit(0).cast("bigint")).alias("n_nan"),
        (_text(F.min(value)) if ordered and is_number else F.min(shown)).alias("least"),
        (_text(F.max(value)) if ordered and is_number else F.max(shown)).alias("most"),
        F.hll_sketch_agg(shown, F.lit(LOG_K)).alias("distinct_sketch"), quantiles.alias("quantile_sketch"))


def columns_profile(df: DataFrame) -> DataFrame:
    """One row per column, from a single pass over the table."""
    measured = df.agg(F.array(*[_of_column(f) for f in df.schema.fields]).alias("all"))
    return measured.select(F.inline("all"))


def with_estimates(profile: DataFrame) -> DataFrame:
    """Replace the sketches by a distinct count and quantiles (null without numbers)."""
    # an empty sketch has no quantiles to ask for
    held = F.kll_sketch_get_n_double("quantile_sketch") > 0
    return profile.withColumn("n_distinct_about", F.hll_sketch_estimate("distinct_sketch")).withColumns({
        f"q{round(100 * q)}": F.when(held, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))) for q in QUANTILES
    }).drop("distinct_sketch", "quantile_sketch")


def merge(*profiles: DataFrame) -> DataFrame:
    """The profile of all parts from those of the parts (least and most as text only where that orders numbers right)."""
    number = F.col("quantile_sketch").isNotNull()
    rows = reduce(DataFrame.unionByName, profiles)
    low, high = F.struct(F.when(number, F.col("least").cast("double")), "least"), F.struct(F.when(number, F.col("most").cast("double")), "most")
    return rows.groupBy("column_name", "kind").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_empty", "n_nan")],
        F.min(F.when(F.col("least").isNotNull(), low))["least"].alias("least"),
        F.max(F.when(F.col("most").isNotNull(), high))["most"].alias("most"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def row_digest(df: DataFrame) -> Column:
    """128 bits of all columns; null and the empty text differ."""
    return F.md5(F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"}))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, repeated rows (beyond the first of each), keys that occur more than once, and rows with those keys.

    Only digests and keys are shuffled, counted before the shuffle.
    """
    rows = df.groupBy(row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    whole = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeated_rows"))
    by_key = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = by_key.agg(F.count(F.lit(1)).alias("n_repeated_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows_of_repeated_keys"))
    return whole.select("n_rows", "n_repeated_rows", known.select("n_repeated_keys").scalar().alias("n_repeated_keys"),
                        known.select("n_rows_of_repeated_keys").scalar().alias("n_rows_of_repeated_keys"))
