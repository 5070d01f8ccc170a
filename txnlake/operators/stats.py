"""Exact grouped median without gathering a group into one task.

Spark's ``median`` / ``percentile`` keep, per group, a map from distinct value
to count, and the final merge of a group happens in one task. For a group that
holds a large share of the rows that map (and its sort) sits on one executor.
``grouped_median`` selects the middle values in narrowing steps instead:

1. rows per (group, value) are counted - a partial hash aggregate;
2. values are put into buckets by a function that never decreases with the value
   and has a bounded number of results, and the counts of each group's buckets are
   summed: at most that many rows per group, whatever its size;
3. a running sum over a group's buckets finds the one that holds each middle
   position; only its values go on, to a finer division between its least and its
   greatest value, and then to a ranking of the values themselves;
4. the two middle values are interpolated exactly as ``percentile(x, 0.5)`` does:
   ``lo + (hi - lo) * 0.5``.

Which rows meet where depends on their values alone: neither the number of
partitions, nor their ids, nor the reuse of an exchange has a part in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COARSE = 64  # buckets for each factor e of the value
FINE = 1 << 16  # divisions of one bucket


def _coarse(v: Column) -> Column:
    """Never decreases with ``v``; at most 2 * 710 * COARSE results for finite values.
    NaN, which sorts last, gets the greatest."""
    size = F.floor(F.least(F.log1p(F.abs(v)), F.lit(710.0)) * COARSE)
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v < 0, -size - 1).otherwise(size)


def _fine(v: Column, least: Column, greatest: Column) -> Column:
    """Never decreases with ``v`` in [least, greatest]; 0 where that cannot be divided."""
    share = (v - least) / F.when(greatest > least, greatest - least)
    return F.when(share.between(0.0, 1.0), F.floor(share * (FINE - 1))).otherwise(F.lit(0))


def _step(parts: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row of ``parts`` that holds position ``_pos`` of each group, running over
    ``by``; ``_pos`` is then counted from its first row on. ``parts`` has one row per
    (keys, by) with its count ``_n``."""
    upto = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = parts.withColumn("_upto", F.sum("_n").over(upto))
    inside = (F.col("_upto") - F.col("_n") < F.col("_pos")) & (F.col("_pos") <= F.col("_upto"))
    return found.filter(inside).withColumn("_pos", F.col("_pos") - F.col("_upto") + F.col("_n")).drop("_upto")


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "median"
) -> DataFrame:
    """One row per group of ``keys`` with the exact median of ``value``. NULL values are
    left out; a group of NULL values only has no row."""
    # short names of our own, so that no input column can clash
    names = [f"_k{i}" for i in range(len(keys))]
    values = df.select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)], F.col(f"`{value}`").cast("double").alias("_v")
    ).filter(F.col("_v").isNotNull())
    counts = values.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_b", _coarse(F.col("_v")))
    buckets = counts.groupBy(*names, "_b").agg(
        F.sum("_n").alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_greatest")
    )
    total = F.sum("_n").over(Window.partitionBy(*names))
    # both middle positions, counted from 1; one and the same in a group of odd size
    middle = F.array(F.floor((total + 1) / 2), F.floor(total / 2) + 1)
    targets = _step(
        buckets.withColumn("_two", middle).select(*buckets.columns, F.posexplode("_two").alias("_m", "_pos")),
        [*names, "_m"], "_b",
    ).drop("_n")

    def same(left: str, right: str, columns: list[str]) -> Column:
        cond = F.lit(True)
        for c in columns:
            cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        return cond

    near = counts.alias("c").join(targets.alias("t"), same("c", "t", [*names, "_b"])).select(
        *[f"c.{n}" for n in names], "c._v", "c._n", "t._m", "t._pos",
        _fine(F.col("c._v"), F.col("t._least"), F.col("t._greatest")).alias("_f"),
    )
    divisions = near.groupBy(*names, "_m", "_pos", "_f").agg(F.sum("_n").alias("_n"))
    spot = _step(divisions, [*names, "_m"], "_f").drop("_n")
    last = near.alias("c").join(spot.alias("t"), same("c", "t", [*names, "_m", "_f"])).select(
        *[f"c.{n}" for n in names], "c._v", "c._n", "t._m", "t._pos"
    )
    picked = _step(last, [*names, "_m"], "_v")
    lo = F.max(F.when(F.col("_m") == 0, F.col("_v")))
    hi = F.max(F.when(F.col("_m") == 1, F.col("_v")))
    return picked.groupBy(*names).agg((lo + (hi - lo) * 0.5).alias(out)).select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)], out
    )


def attach_median(
    aggregated: DataFrame, df: DataFrame, keys: Sequence[str], value: str, out: str
) -> DataFrame:
    """Join the grouped median of ``df`` onto an aggregate with the same keys.

    Both sides hold one row per group, so AQE broadcasts the median side when
    its measured size is small. With no keys a constant key joins the two
    one-row frames.
    """
    keys = list(keys)
    if not keys:
        one = "_one"
        med = grouped_median(df.withColumn(one, F.lit(1)), [one], value, out)
        return aggregated.withColumn(one, F.lit(1)).join(med, one, "left").drop(one)
    med = grouped_median(df, keys, value, out)
    a, m = aggregated.alias("a"), med.alias("m")
    cond = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"m.`{k}`")) for k in keys]
    return a.join(m, cond, "left").select("a.*", F.col(f"m.`{out}`").alias(out))
