"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies (target
words over source words). Documents of a source are put in one order (size,
then a hash of the id), the expected copies are prefix-summed along it, one
random offset per source is added, and a document is emitted once for each
integer boundary its stretch of the sum crosses. Because the order is by size,
the words taken follow the target closely.

Only DataFrame operations are used. The prefix sum is built in three levels
(sizes of a source, hash slots of a size, rows of a slot), each aggregated
before it is summed, so no task holds all rows of a large source; texts are
never shuffled.

Edge cases: a null text has size 0 and takes 0 words; a null source is a
source of its own, ordered last; repeated rows are separate documents; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN

SLOTS = 256


def hash32(text: Column) -> Column:
    """First 32 bits of the md5 of a text as a long (the same in other SQL engines)."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(5, 2, 1), share_num: int = 3, share_den: int = 2,
                   most: int = 2) -> DataFrame:
    """(source, source_size, target): the words each source should give.

    Sources ordered by code point (null last) weigh ``weights`` in turn and
    share ``share_num / share_den`` of all words. A target stops at ``most``
    times its source's size; the excess is shared again by weight until none
    is above. Ordering the sources by size over weight turns this into one
    running sum: the sources before the first one that stays below its limit
    are full. The windows run over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(
        F.array(*[F.lit(x) for x in weights]),
        (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ranked = per_source.withColumn("weight", w)
    everything = Window.partitionBy(F.lit(0))
    by_ratio = everything.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    full = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("size_before", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # words left for this source and all later ones, per unit of weight
        .withColumn(
            "level",
            (share_num * F.col("total") / share_den - most * F.col("size_before"))
            / (F.col("all_weight") - F.col("weight_before")),
        )
        .withColumn("below", F.col("level") * F.col("weight") < most * F.col("source_size"))
    )
    # the first source below its limit sets the level of all that follow
    level = F.min(F.when(F.col("below"), F.struct(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"),
        F.col("level").alias("level"),
    ))).over(everything)
    return full.withColumn("cut", level).select(
        "source",
        "source_size",
        F.coalesce(
            F.least(
                F.col("cut.level") * F.col("weight"), (most * F.col("source_size")).cast("double")
            ),
            (most * F.col("source_size")).cast("double"),
        ).alias("target"),
    )


def mix(docs: DataFrame, seed: str = "mix", carry: bool = False, **params) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every document;
    with ``carry`` also ``doc``, the whole row."""
    whole = [F.struct(*[docs[c] for c in docs.columns]).alias("doc")] if carry else []
    rows = docs.select(
        *whole,
        "doc_id",
        "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_PATTERN)), F.lit(0))
        .cast("long")
        .alias("size"),
        hash32(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
        .alias("h"),
    ).withColumn("slot", (F.col("h") % SLOTS).cast("int"))

    counts = rows.groupBy("source", "size", "slot").agg(F.count("*").alias("n"))
    per_size = counts.groupBy("source", "size").agg(F.sum("n").alias("size_n"))
    preceding = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sizes = per_size.select(
        "source",
        "size",
        F.coalesce(
            F.sum("size_n").over(preceding(Window.partitionBy("source").orderBy("size"))),
            F.lit(0),
        ).alias("size_offset"),
    )
    slots = counts.withColumn(
        "slot_offset",
        F.coalesce(
            F.sum("n").over(preceding(Window.partitionBy("source", "size").orderBy("slot"))),
            F.lit(0),
        ),
    ).drop("n")
    targets = source_targets(
        per_size.select("source", (F.col("size") * F.col("size_n")).alias("size")), **params
    )

    def on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        r = right.select(*[F.col(k).alias("r_" + k) if k in keys else F.col(k)
                           for k in right.columns])
        cond = [F.col(k).eqNullSafe(F.col("r_" + k)) for k in keys]
        return left.join(r, cond, "left").drop(*["r_" + k for k in keys])

    offsets = on(on(slots, sizes, ["source", "size"]), targets, ["source"])
    within = Window.partitionBy("source", "size", "slot").orderBy("h", "doc_id")
    placed = on(
        rows.withColumn("rank", F.row_number().over(within)), offsets, ["source", "size", "slot"]
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        F.lit(0.0)
    )
    start = hash32(
        F.concat(F.lit(seed + "#"), F.coalesce(F.col("source"), F.lit("\u0000null")))
    ) / F.lit(4294967296.0)
    last = (F.col("size_offset") + F.col("slot_offset") + F.col("rank")).cast("double")
    crossed = F.floor(start + rate * last) - F.floor(start + rate * (last - 1.0))
    return placed.select(
        *(["doc"] if carry else []), "doc_id", "source", "size", "source_size", "target",
        crossed.cast("long").alias("copies"),
    )


def mixture(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mixture, each as often as it was drawn."""
    drawn = mix(docs, carry=True, **params).filter(F.col("copies") > 0)
    copied = F.explode(F.array_repeat("doc", F.col("copies").cast("int")))
    return drawn.select(copied.alias("doc")).select("doc.*")
