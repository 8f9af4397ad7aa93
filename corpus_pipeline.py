"""Documents to training tokens, in stages that are each written and read again.

Every stage works on all rows its predecessor kept and drops the rows that its operator
rejects. Rows are told apart by a number of their own, given where a stage's input is
written, so ids may be of any type, missing or repeated. The last stage returns the
token ids instead of the text. Columns of the input keep their names and values,
whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callejero.llm import bpe, decontaminate, hierarchy, language, neardup
from callejero.session import scratch_dir

TOKENIZER = "byte_bpe_50k.tiktoken"
#: documents below this probability of being good go
LEAST_QUALITY = 0.5
#: near copies share at least this percentage of their runs of so many words
SHINGLE, PERCENT = 5, 80
#: beginnings of names that no input column has, and the row number
OWN = "__own_"
ROW = "__own_row"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a number each, written to the shared folder, so that it is the same wherever it is read."""
    path = scratch_dir(docs.sparkSession, name)
    # a third smaller than with the default compression; the copies stay until the application ends
    docs.withColumn(ROW, F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _without(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    return rows.join(rejected.select(ROW), ROW, "left_anti").drop(ROW)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and those whose language is ambiguous; without a language to learn, the former only."""
    model = language.train(docs)
    if not model.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    judged = language.predict(docs, model, prefix=OWN)
    good = (F.col(f"{OWN}lang_pred") != language.UNKNOWN) & ~F.col(f"{OWN}ambiguous")
    return judged.filter(good).select(*[F.col(f"`{c}`") for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are probably bad, judged by text, site and section; labels are given by id."""
    rows = _numbered(docs, "quality")
    given = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("of"), "quality")
    labels = rows.select(F.col("doc_id").cast("string").alias("of"), ROW).join(given, "of").select(ROW, "quality")
    judged = hierarchy.assess(rows, labels, key=ROW, threshold=LEAST_QUALITY)
    return _without(rows, judged.filter("NOT kept"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first row of each group of near copies."""
    rows = _numbered(docs, "copies")
    found = neardup.components(rows, SHINGLE, PERCENT, key=ROW)
    return _without(rows, found.filter(F.col("component_id") != F.col(ROW)))


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of a benchmark item."""
    rows = _numbered(docs, "benchmarks")
    found = decontaminate.contamination(rows, _table(spark, sf_dir, "benchmark"), key=ROW)
    return _without(rows, found.filter("n_hit > 0"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path(TOKENIZER))
    made = bpe.digests(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, with_ids=True)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return made.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256",
                       (F.col("decoded_sha256") == digest).alias("round_trip"))


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near copies", one_of_near_copies),
    ("decontamination", clean_of_benchmarks),
    ("tokens", tokens),
]

# models are fitted in the first two stages, which SQL can't express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next."""
    docs = _table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
