"""Addresses judged by rules, and beyond them by two character models.

The models are variable-order Markov models of up to ``ORDER`` characters of
context, one of the addresses that a rule allows and one of those that a rule
blocks, each smoothed towards shorter contexts in proportion to the number of
different characters seen after a context (Witten and Bell). The score of an
address is the difference of its log-likelihoods by character. Three quarters of
the addresses with a rule are counted; on the last quarter the least score to
allow is set where the share of allowed addresses above it exceeds that of
blocked ones by most.

Everything is grouping, joining and windows over character sequences: counts of
the longest sequences are taken once, those of shorter ones are sums of them, and
all tables but the first hold distinct sequences. Each of them is written to the
shared folder, which keeps the plans, and what the driver holds for them, small.
Log ratios are whole millionths, so sums don't depend on their order.

A null address or one without ``://`` has an empty host and path, fits no rule and
scores 0. A side without any address makes every score 0 and the threshold 0.
Repeated rows count and are judged alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callejero.session import scratch_dir

ORDER = 4
ALPHABET = 256
SCALE = 1_000_000
BIN = 10_000
LAST_BIN = 2_000


def host_of(url: Column) -> Column:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the host or a domain above it and whose path begins the path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _pieces(text: Column, order: int) -> Column:
    """All sequences of ``order`` characters of context and one more; the end is a character too."""
    padded = F.concat(F.lit("\x02" * order), text, F.lit("\x03"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(order + 1)))


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Log ratio of both models for each sequence; ``counts``: piece, n1 (allowed), n0 (blocked)."""
    folder = scratch_dir(counts.sparkSession, "characters")
    tables = [_kept(counts, f"{folder}/counts-{order + 1}")]
    for size in range(order, 0, -1):
        tables.append(_kept(tables[-1].groupBy(F.substring("piece", 2, size).alias("piece")).agg(
            F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), f"{folder}/counts-{size}"))
    done = None
    for size, level in enumerate(reversed(tables), start=1):
        context = F.substring("piece", 1, size - 1)
        totals = level.groupBy(context.alias("context")).agg(
            F.sum("n1").alias("t1"), F.sum("n0").alias("t0"),
            F.sum((F.col("n1") > 0).cast("bigint")).alias("k1"), F.sum((F.col("n0") > 0).cast("bigint")).alias("k0"))
        step = level.withColumn("context", context).join(totals, "context")
        if done is None:
            step = step.withColumn("q1", F.lit(1 / ALPHABET)).withColumn("q0", F.lit(1 / ALPHABET))
        else:
            shorter = done.select(F.col("piece").alias("tail"), F.col("p1").alias("q1"), F.col("p0").alias("q0"))
            step = step.withColumn("tail", F.substring("piece", 2, size - 1)).join(shorter, "tail")

        def chance(side: int) -> Column:
            n, t, k, q = (F.col(f"{c}{side}") for c in "ntkq")
            return F.when(t > 0, (n + k * q) / (t + k)).otherwise(q)

        done = _kept(step.select("piece", "n1", "n0", chance(1).alias("p1"), chance(0).alias("p0")),
                     f"{folder}/chances-{size}")
    return done.select("piece", F.round(F.log(F.col("p1") / F.col("p0")) * SCALE).cast("bigint").alias("ratio"))


def judge(df: DataFrame, rules: dict[str, str], url: str = "url", order: int = ORDER) -> DataFrame:
    """Add host, path, rule, score (null where a rule decides) and verdict."""
    added = {"host", "path", "rule", "score", "verdict"}
    kept = [c for c in df.columns if c.lower() not in added or c == url]
    found = df.select(*[f"`{c}`" for c in kept]).withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    found = found.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = F.col("rule").isin([r for r, v in rules.items() if v == "allow"])
    found = found.withColumn("_text", F.concat("host", "path"))
    # the rule is a function of the text, so a text stands for all its addresses
    texts = found.groupBy("_text").agg(
        F.count("*").alias("n"), F.max(F.when(allowed, 1).when(F.col("rule").isNotNull(), 0)).alias("side"))
    texts = texts.withColumn("held", F.crc32(F.col("_text").cast("binary")) % 4 == 0)
    counted = F.col("side").isNotNull() & ~F.col("held")
    pieces = texts.select(
        F.explode(_pieces(F.col("_text"), order)).alias("piece"),
        F.when(counted & (F.col("side") == 1), F.col("n")).otherwise(0).alias("n1"),
        F.when(counted & (F.col("side") == 0), F.col("n")).otherwise(0).alias("n0"))
    ratios = log_ratios(pieces.groupBy("piece").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")), order)
    asked = texts.filter(F.col("side").isNull() | F.col("held"))
    scored = asked.select("_text", "n", "side", F.explode(_pieces(F.col("_text"), order)).alias("piece")).join(
        ratios, "piece").groupBy("_text", "n", "side").agg((F.sum("ratio") / F.count("*")).alias("_mean"))
    scored = _kept(scored, f"{scratch_dir(df.sparkSession, 'addresses')}/scored")
    bins = scored.filter(F.col("side").isNotNull()).groupBy(
        F.greatest(F.least(F.floor(F.col("_mean") / BIN), F.lit(LAST_BIN)), F.lit(-LAST_BIN)).alias("bin")).agg(
        F.sum(F.when(F.col("side") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("side") == 0, F.col("n")).otherwise(0)).alias("n0"))
    # at most 2 * LAST_BIN + 1 bins
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gain = (F.sum("n1").over(above) * F.sum("n0").over(whole) - F.sum("n0").over(above) * F.sum("n1").over(whole))
    cut = bins.select("bin", gain.alias("gain")).agg(
        F.max_by("bin", F.struct("gain", (-F.abs("bin")).alias("near"), "bin"))).scalar()
    scores = scored.filter(F.col("side").isNull()).select("_text", F.col("_mean"))
    judged = found.join(scores, "_text", "left")
    score = F.when(F.col("rule").isNull(), F.coalesce("_mean", F.lit(0.0)) / SCALE)
    by_model = F.coalesce(F.col("_mean"), F.lit(0.0)) >= F.coalesce(cut, F.lit(0)) * BIN
    verdict = F.when(F.col("rule").isNotNull(), F.when(allowed, "allow").otherwise("block")).otherwise(
        F.when(by_model, "allow").otherwise("block"))
    return judged.withColumn("score", score).withColumn("verdict", verdict).drop("_text", "_mean")
