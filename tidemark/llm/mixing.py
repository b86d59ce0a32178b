"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson number of times, with its source's target repetition rate
as the mean. The number is read off the inverted distribution at a hash of the document, so a
task run again repeats the same documents. Copies are then shuffled globally by another hash.

Defined cases: a null source is a source of its own; a source without target gets weight 0 and
is left out; repeated rows are drawn alike; null texts are replicated as they are; an empty table
gives an empty table; columns of other names are carried on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Without target weights, a source weighs the square root of its documents.
TEMPERATURE = 0.5
#: Hex digits of a hash that make a number in [0, 1).
_DIGITS = 13


def _uniform(salt: str) -> Column:
    """A number in [0, 1) from a hash of the document id."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("double")
    return (number + 0.5) / float(16**_DIGITS)


def _distribution(rate: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until nothing is left."""
    if not rate > 0:
        return [1.0]
    out, total, k = [], 0.0, 0
    while k <= rate or total < 1.0 - 2.0**-50:
        p = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if k > rate and p < 1e-18:
            break
        total += p
        out.append(total)
        k += 1
    return out


def rates(documents: DataFrame, weights: DataFrame | None = None, total: float | None = None) -> DataFrame:
    """(source, n_docs, rate): the repetition rate that gives each source its share of ``total``
    documents (by default as many as there are). ``weights`` has (source, weight)."""
    counts = documents.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow("n_docs", F.lit(TEMPERATURE)))
    else:
        target = weights.select(F.col("source").alias("_target"), F.col("weight").cast("double").alias("weight"))
        weighed = counts.join(target, F.col("source").eqNullSafe(F.col("_target")), "left").drop("_target")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    sums = weighed.agg(F.sum("weight").alias("_w"), F.sum("n_docs").alias("_n")).withColumn("_one", F.lit(1))
    wanted = F.col("_n") if total is None else F.lit(float(total))
    share = F.when(F.col("_w") > 0, F.col("weight") / F.col("_w")).otherwise(F.lit(0.0))
    return weighed.withColumn("_one", F.lit(1)).join(sums, "_one").select(
        "source", "n_docs", (share * wanted / F.col("n_docs")).alias("rate")
    )


def replicate(
    documents: DataFrame, weights: DataFrame | None = None, total: float | None = None, seed: str = "mix",
    copy: str = "copy", shuffle_key: str = "shuffle_key",
) -> DataFrame:
    """Columns of the documents and ``copy`` (from 0), ``shuffle_key``; in the order of the key.
    Given columns of these two names are replaced; choose other names to keep them."""

    @F.pandas_udf("array<double>")
    def distribution(rate: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in rate:
            yield values.map(_distribution)

    tables = rates(documents, weights, total).select(F.col("source").alias("target"), distribution("rate").alias("below"))
    # Columns of the documents may have any name: they travel as one. Sources may be many, so the
    # join is left to the planner; skewed sources are split by it.
    joined = documents.select(F.struct("*").alias("d"), "source", "doc_id").join(tables, F.col("source").eqNullSafe(F.col("target")))
    drawn = joined.withColumn("u", _uniform(f"{seed}:count")).withColumn(
        "reps", F.size(F.filter("below", lambda p: p < F.col("u")))
    ).where("reps > 0")
    copies = drawn.select("d", "doc_id", F.explode(F.sequence(F.lit(0), F.col("reps") - 1)).alias("k"))
    key = F.md5(F.concat(F.lit(f"{seed}:place:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("k").cast("string")).cast("binary"))
    kept = [F.col("d").getField(c).alias(c) for c in documents.columns if c not in (copy, shuffle_key)]
    return copies.withColumn("key", key).orderBy("key").select(*kept, F.col("k").alias(copy), F.col("key").alias(shuffle_key))
