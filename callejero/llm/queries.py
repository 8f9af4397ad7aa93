"""One query per operator over its whole table, with production parameters, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callejero.llm import (
    bpe, decontaminate, hierarchy, language, neardup, oracles, repetition, resample, sharding, spelling, tagpaths,
    tokenfiles, toxicity, urlfilter,
)
from callejero.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LIMITS = repetition.Limits()


@query(oracles.repetition(repetition.WINDOW, LIMITS.least, LIMITS.share, LIMITS.longest))
def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document and whether its repeats are within limits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repetition.judge(docs, limits=LIMITS).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words")


@query(oracles.neardup(4, neardup.PERCENT))
def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document among texts that share four fifths of their shingles."""
    found = neardup.components(table(spark, sf_dir, "documents"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _remainder(count: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % count


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is toxic, learned from the labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    labels = labels.select("doc_id", "toxic").filter(_remainder(4) != 2)
    model = toxicity.train(docs, labels, calibration=_remainder(4) == 3)
    return toxicity.passages(docs, model).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("segments").alias("n_passages"))


@query()
def op4_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good, from its text and from its site and section."""
    return hierarchy.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
             "com/de/": "block"}


@query(oracles.url_models(URL_RULES, urlfilter.ORDER, urlfilter.ALPHABET, urlfilter.SCALE, urlfilter.BIN,
                          urlfilter.LAST_BIN))
def op5_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page, by rule or else by the character models."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


@query()
def op6_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return tagpaths.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query(oracles.winnowing(decontaminate.WINDOW))
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside passages of benchmark items, and these items."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(_remainder(3) != 1))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (_remainder(3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


@query()
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, their digest and the digest of what they decode to."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


SHARDS = 16
SHARD_SEED = "callejero"


@query(oracles.sharding(SHARDS, SHARD_SEED))
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of the mixture of all sources; counts differ by one at most."""
    placed = sharding.interleave(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query(oracles.spelling(spelling.LEAST_LETTERS, spelling.LEAST_COUNT, spelling.TIMES, spelling.DROP_EVERY))
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words, the word each is a variant of, and the root of that."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", F.col("n_near").cast("bigint"), "form_n")


@query()
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and checksum of every document's token ids, read back from the files."""
    import public_tokenizers

    docs, folder = table(spark, sf_dir, "documents"), scratch_dir(spark, "tokenfiles")
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as lines:
        tokenfiles.write(docs, folder, lines.read())
    return tokenfiles.read(spark, folder, with_ids=False)


@query(oracles.resample(resample.LONGEST, resample.BUCKETS, 5, 20, "42"))
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark's texts, and the ranks of the twentieth that is drawn."""
    drawn = resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
