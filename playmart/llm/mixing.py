"""Mixing sources to target weights (operator 2).

Words are summed per source, the targets follow from the weights (capped, the excess reshared), and
the repetition rate of a source is target / size. Every document is emitted floor(rate) times plus
one hash-seeded Bernoulli copy whose probability is the fraction of the rate. Of ``TRIALS``
independent hash seeds each source uses the one whose total of taken words comes nearest to its
target; all trials are summed in the same single aggregation, so a source with few or very long
documents still lands near its target and a rerun takes the same copies.

Only one row per source is ever gathered by a window; per-document work is one projection and one
join with that table.

Defined results: null text has size 0; a null source is a source of its own, ordered last; a
source without words has target 0 and rate 0; rows that repeat a doc_id share one draw; a null
doc_id draws like the text "null". ``mix`` returns the input's columns, copies as repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import documents, n_words, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
TRIALS = 8


def draws(doc_id: Column, trials: int = TRIALS) -> Column:
    """``trials`` uniform numbers in [0, 1) from the SHA-256 of the id, 32 bits each."""
    h = F.sha2(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    return F.array(*(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
                     for i in range(trials)))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, target, rate, whole, fraction.

    Resharing the excess by weight until nobody is above the cap gives min(most * size, level *
    weight) for one common level; it is found by a running sum over sources ordered by the level
    at which each reaches its cap.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    pos = F.pmod(rank - 1, F.lit(len(weights))) + 1
    ranked = (by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), pos.cast("int")))
              .withColumn("cap", most * F.col("source_size")))
    w = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (ranked.withColumn("total", share * F.sum("source_size").over(whole))
             .withColumn("open", F.col("total") - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
             .withColumn("level", F.col("open") / F.sum("weight").over(upto))
             .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap"))
             .withColumn("level", F.max(F.when(F.col("fits"), F.col("level"))).over(whole)))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return (level.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
            .withColumn("whole", F.floor("rate"))
            .select("source", "source_size", "target", "rate", "whole", (F.col("rate") - F.col("whole")).alias("fraction")))


def plan(sizes: DataFrame, trials: int = TRIALS, **kw) -> DataFrame:
    """``targets`` with the number (from 0) of the hash seed that each source uses."""
    rates = targets(sizes, **kw)
    known = rates.select(F.col("source").alias("_source"), "fraction")
    u = (sizes.join(known, F.col("source").eqNullSafe(F.col("_source")))
         .select("source", "size", "fraction", draws(F.col("doc_id"), trials).alias("u")))
    extra = (u.groupBy(F.col("source").alias("_source"))
             .agg(*(F.sum(F.when(F.col("u")[i] < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"e{i}")
                    for i in range(trials))))
    joined = rates.join(extra, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    off = F.array(*(F.abs(F.col("whole") * F.col("source_size") + F.col(f"e{i}") - F.col("target")) for i in range(trials)))
    return (joined.withColumn("off", off)
            .withColumn("seed", (F.array_position("off", F.array_min("off")) - 1).cast("int"))
            .drop("off", *(f"e{i}" for i in range(trials))))


def copies(sizes: DataFrame, trials: int = TRIALS, **kw) -> DataFrame:
    """``sizes`` (doc_id, source, size, ...) with the source's plan and ``copies`` of each document."""
    p = plan(sizes, trials, **kw).withColumnRenamed("source", "_source")
    drawn = F.get(draws(F.col("doc_id"), trials), F.col("seed"))
    n = F.col("whole") + (drawn < F.col("fraction")).cast("long")
    return (sizes.join(p, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("copies", n.cast("long")))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str | None = None) -> DataFrame:
    """The mixed corpus: each document's row as often as the mix takes it, with the columns of ``docs``."""
    p = plan(stored(sized(docs), "mix-sizes")).select(F.col("source").alias("_source"), "whole", "fraction", "seed")
    drawn = F.get(draws(F.col("doc_id")), F.col("seed"))
    n = F.col("whole") + (drawn < F.col("fraction")).cast("long")
    rows = docs.join(p, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_n", n.cast("int"))
    return (rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_n"))))
            .select(*(F.col(f"`{c}`") for c in docs.columns)))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = stored(sized(documents(spark, sf_dir)), "mix-sizes")
    return copies(sizes).select("doc_id", "size", "source_size", "target",
                                (F.col("copies") * F.col("size")).alias("taken"))


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         sha256('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM sizes GROUP BY source),
lvl AS (
  SELECT a.source, (1.5 * (SELECT sum(source_size) FROM src)
                    - coalesce(sum(2.0 * b.source_size) FILTER (2.0 * b.source_size / b.weight < 2.0 * a.source_size / a.weight), 0))
                   / sum(b.weight) FILTER (2.0 * b.source_size / b.weight >= 2.0 * a.source_size / a.weight) AS level,
         any_value(2.0 * a.source_size / a.weight) AS reach
  FROM src a, src b GROUP BY a.source),
tgt AS (
  SELECT source, source_size,
         least(2.0 * source_size, (SELECT max(level) FROM lvl WHERE level <= reach) * weight) AS target
  FROM src),
rate AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM tgt),
drawn AS (
  SELECT s.*, r.source_size, r.target, floor(r.rate) AS whole, r.rate - floor(r.rate) AS fraction, t.t,
         CAST(('0x' || substr(s.h, 8 * t.t + 1, 8)) AS BIGINT) / 4294967296.0 AS u
  FROM sizes s JOIN rate r ON s.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range(8)) AS t) t),
seeds AS (
  SELECT source, t, abs(sum(whole * size + CASE WHEN u < fraction THEN size ELSE 0 END) - any_value(target)) AS off
  FROM drawn GROUP BY source, t),
best AS (SELECT source, arg_min(t, (off, t)) AS t FROM seeds GROUP BY source)
SELECT d.doc_id, d.size, d.source_size, CAST(d.target AS DOUBLE) AS target,
       CAST((whole + CASE WHEN u < fraction THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM drawn d JOIN best b ON d.source IS NOT DISTINCT FROM b.source AND d.t = b.t
"""
