"""Line dedup: range-partitioned line hashes, first occurrences streamed, keep bitmaps out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback.llm.common import WHITE, ascii_lower, order_id, set_aside


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, salts: int = 64) -> DataFrame:
    """Keep bitmaps of the documents that lose lines, without any text.

    A key of ``min_chars`` code points or more loses its lines in every document
    but the one of smallest doc_id. Line hashes (128 bits) are range-partitioned
    by (hash, salt of the document) and sorted by document and position in each
    part, so a line that a third of all documents hold is streamed in ``salts``
    pieces; only the first document of each piece takes part in the second step,
    at most ``salts`` documents a key.

    Returns ``doc`` (sort key of doc_id), ``content`` (hash of the text) and
    ``dropped``: the runs of dropped lines, array<struct<start, length>>.
    Rows that repeat a doc_id count as one document, as do rows without one;
    null texts are one empty line; an empty table gives an empty one.
    """
    doc, content = order_id(F.col("doc_id")), F.xxhash64("text")
    lines = docs.select(doc.alias("doc"), content.alias("content"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc", "content", "pos", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_chars)
    hashes = keyed.select(
        F.unhex(F.md5("key")).alias("hash"), F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int").alias("salt"), "doc", "pos", "content"
    )
    ordered = hashes.repartitionByRange("hash", "salt").sortWithinPartitions("hash", "salt", "doc", "pos")
    stream = Window.partitionBy("hash", "salt").orderBy("doc", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = ordered.withColumn("first", F.first("doc").over(stream))
    later = seen.filter(F.col("doc") > F.col("first"))
    firsts = seen.filter(F.col("doc") == F.col("first"))
    across = firsts.withColumn("earliest", F.min("doc").over(Window.partitionBy("hash"))).filter(F.col("doc") > F.col("earliest"))
    gone = later.select("doc", "content", "pos").unionByName(across.select("doc", "content", "pos"))
    drops = gone.groupBy("doc", "content").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    at = F.col("at")
    starts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
    ends = F.filter(at, lambda p, i: (i == F.size(at) - 1) | (F.get(at, i + 1) != p + 1))
    runs = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda r: F.struct(r["a"].alias("start"), (r["b"] - r["a"] + 1).alias("length")))
    return drops.select("doc", "content", runs.alias("dropped"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its columns plus ``kept_text``, ``n_lines`` and ``n_dropped``.

    Own columns of those names are replaced, all others stay.
    """
    docs, back = set_aside(docs, "__doc", "__content", "__dropped", "__lines")
    marked = docs.select(*[c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]).withColumns(
        {"__doc": order_id(F.col("doc_id")), "__content": F.xxhash64("text")}
    )
    b = bitmaps.select(F.col("doc").alias("__doc"), F.col("content").alias("__content"), F.col("dropped").alias("__dropped"))
    joined = marked.join(b, ["__doc", "__content"], "left").withColumn("__lines", split_lines(F.col("text")))
    lines, dropped = F.col("__lines"), F.coalesce("__dropped", F.array().cast("array<struct<start:int,length:int>>"))
    last = F.size(dropped) - 1
    end_of = lambda r: r["start"] + r["length"]
    before = F.flatten(
        F.transform(dropped, lambda r, i: F.slice(lines, F.when(i == 0, 1).otherwise(end_of(F.get(dropped, i - 1)) + 1),
                                                  F.when(i == 0, r["start"]).otherwise(r["start"] - end_of(F.get(dropped, i - 1)))))
    )
    tail_from = end_of(F.get(dropped, last))
    kept = F.concat(before, F.slice(lines, tail_from + 1, F.size(lines) - tail_from))
    return joined.withColumns({
        "kept_text": F.when(F.col("__dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(kept, "\n")),
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.aggregate(dropped, F.lit(0), lambda a, r: a + r["length"]), F.lit(0)).cast("long"),
    }).drop("__doc", "__content", "__dropped", "__lines").withColumnsRenamed(back)


def dedup_lines(docs: DataFrame, min_chars: int = 10, salts: int = 64) -> DataFrame:
    return drop_lines(docs, keep_bitmaps(docs, min_chars, salts))
