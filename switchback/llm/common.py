"""Helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from switchback.session import cut_lineage

#: ASCII white space, ``[\x20\x09-\x0D]``.
WHITE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most rows of a narrow table that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: Texts in an Arrow batch.
BATCH_ROWS = 500


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fresh_name(df: DataFrame, name: str, *more: str) -> str:
    """``name``, with underscores until no column of ``df`` and none of ``more`` is called so."""
    taken = {c.lower() for c in (*df.columns, *more)}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns called like one of ``names`` under other names, and how to name them back."""
    aside: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in names:
            aside[c] = fresh_name(df, f"{c}_own", *names, *aside.values())
    return df.withColumnsRenamed(aside), {new: old for old, new in aside.items()}


def order_id(doc_id: Column) -> Column:
    """A doc_id to sort by; rows without one come last and count as one document."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to hand Python workers at most BATCH_ROWS rows at once.

    Whole texts lie in such a batch several times over, so it decides a worker's memory.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def landed_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Lands a narrow table and marks it for broadcast if its counted rows allow that.

    Beyond ``limit`` rows it is joined by shuffle; the result is the same.
    """
    landed = cut_lineage(df)
    return F.broadcast(landed) if landed.count() <= limit else landed
