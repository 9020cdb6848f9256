"""Mixing sources to target weights by repetition rates and hash-seeded copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback.llm.common import WORD, landed_small, set_aside

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """``source, source_size, target, rate`` from rows of (source, size).

    Sources rank by code point, null last. All sizes are shared by weight; a
    target stops at ``most`` times its source's size and the excess is shared
    again. That ends at a common level: with sources sorted by size over
    weight, the first k are full, and target = weight * level for the others.
    The windows run over one row per source, after the sums.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    shared = weighed.withColumns({
        "full": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most,
        "light": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "total": F.sum("source_size").over(everything),
        "heavy": F.sum("weight").over(everything),
    }).withColumns({"num": F.col("total") - F.col("full"), "den": F.col("heavy") - F.col("light")})
    # full when the level that the earlier ones leave is above what the source holds
    tight = F.col("weight") * F.col("num") >= most * F.col("source_size") * F.col("den")
    marked = shared.withColumn("tight", tight)
    level = F.min(F.when(~F.col("tight"), F.struct((F.col("source_size") / F.col("weight")).alias("fill"), "rank", "num", "den"))).over(everything)
    settled = marked.withColumn("level", level)
    target = F.when(F.col("tight"), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.col("level.num")).cast("double") / F.col("level.den").cast("double")
    )
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    return settled.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"))


def unit_hash(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that only ``doc_id`` and ``seed`` decide."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def with_copies(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """Every row of ``docs`` with ``__size, __source_size, __target`` and ``__copies``.

    ``__copies`` is floor(rate) plus one where the hash of doc_id is below the
    fraction of the rate, so reruns agree and no row is taken more than ``most``
    times. Null texts have size 0; a source of size 0 takes none; rows that
    repeat a doc_id share one draw; a null source is a source of its own.
    """
    sized = docs.withColumn("__size", word_count(F.col("text")))
    targets = landed_small(source_targets(sized.select("source", F.col("__size").alias("size")), weights, most)).select(
        F.col("source").alias("__s"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("rate").alias("__rate")
    )
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__s")))
    whole = F.floor("__rate")
    extra = (unit_hash(F.col("doc_id"), seed) < F.col("__rate") - whole).cast("int")
    return joined.withColumn("__copies", (whole + extra).cast("int")).drop("__s", "__rate")


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns of ``docs`` whatever their names."""
    own, back = set_aside(docs, "__size", "__source_size", "__target", "__copies", "__s", "__rate", "__copy")
    taken = with_copies(own, seed, weights, most).filter(F.col("__copies") > 0)
    taken = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return taken.select(*own.columns).withColumnsRenamed(back)
