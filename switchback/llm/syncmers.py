"""Document fingerprints by closed syncmers, in Spark expressions only.

A text of any length is a sequence of units: a run of Latin letters ends behind
its first ``a``, ``e`` or ``o``, every other sign but white space is a unit. Where
a unit ends depends on its own signs only, also within a long run, so an
insertion changes the units it lies in and no others. A k-mer of units is an
anchor when the least hash among its s-mers is at one of its edges. Whether a
k-mer is an anchor depends on nothing around it, so what two texts share keeps
its anchors in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from switchback.llm.common import fresh_name, landed_small, order_id

UNIT = r"[\p{IsLatin}&&[^aeoAEO]]+[aeoAEO]?|\S"
K, S = 6, 2


def _tail(x: Column, skip: int) -> Column:
    return F.slice(x, skip + 1, F.greatest(F.size(x) - skip, F.lit(0)))


def _head(x: Column, less: int) -> Column:
    return F.slice(x, 1, F.greatest(F.size(x) - less, F.lit(0)))


def with_anchors(df: DataFrame, text: str, at: str, hashes: str, k: int = K, s: int = S) -> DataFrame:
    """Adds the anchors of column ``text``: unit positions ``at`` array<int> and ``hashes`` array<int>.

    ``s`` divides ``k``. A text without an anchor, such as one of fewer than
    ``k`` units, is one anchor as a whole; one without units (null, empty,
    white space) has none. Rows and other columns stay; no shuffle. The arrays
    of a text lie in its row, so a text may be as long as a row can hold.
    """
    units, smers = fresh_name(df, "units", text, at, hashes), fresh_name(df, "smers", text, at, hashes)
    inner = k - s + 1
    whole_text = F.coalesce(F.col(text), F.lit(""))
    cut = F.regexp_extract_all(whole_text, F.lit(UNIT), F.lit(0))
    df = df.withColumn(units, F.transform(cut, lambda u: F.xxhash64(u)))
    x = F.col(units)
    for j in range(1, s):
        x = F.zip_with(_head(x, 1), _tail(F.col(units), j), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn(smers, x)
    x, n = F.col(smers), F.size(units)

    def edge(i: Column) -> Column:
        parts = [F.get(x, i + j) for j in range(inner)]
        middle = F.least(*parts[1:-1]) if inner > 3 else parts[1]
        return F.least(parts[0], parts[-1]) <= middle

    found = F.filter(F.sequence(F.lit(0), n - k), edge)
    df = df.withColumn(at, F.when(n >= k, found).otherwise(F.array().cast("array<int>")))
    hashed = F.transform(F.col(at), lambda i: F.hash(*[F.get(x, i + j) for j in range(0, k, s)]))
    whole = F.when(n > 0, F.array(F.hash(F.col(units)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(hashes, F.when(F.size(at) > 0, hashed).otherwise(whole))
    return df.withColumn(at, F.when((F.size(at) == 0) & (n > 0), F.array(F.lit(0))).otherwise(F.col(at))).drop(units, smers)


def as_text(hashes: Column) -> Column:
    """Anchors in order, eight hexadecimal digits or fewer each, joined by dots."""
    return F.array_join(F.transform(hashes, lambda h: F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over all anchors, of sets; 1 for two texts without any."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def shared_anchors(at_a: Column, a: Column, at_b: Column, b: Column) -> Column:
    """Matching positions, array<struct<a, b>>, of anchors that occur once in both texts."""
    once = lambda h, of: F.size(F.filter(of, lambda y: y == h)) == 1
    pairs = F.filter(F.arrays_zip(at_a.alias("at"), a.alias("hash")), lambda p: once(p["hash"], a) & once(p["hash"], b))
    return F.transform(pairs, lambda p: F.struct(p["at"].alias("a"), F.get(at_b, F.array_position(b, p["hash"]).cast("int") - 1).alias("b")))


def in_buckets(docs: DataFrame, parts: int) -> DataFrame:
    """``bucket, doc, text, own``: consecutive doc_ids share a bucket, and each bucket ends with the first row of the next.

    Cut points are quantiles of doc_id, at most ``parts`` numbers on the driver.
    That last row, ``own`` false, wraps around from the last bucket to the first.
    """
    rows = docs.select(order_id(F.col("doc_id")).alias("doc"), "text")
    steps = [i / parts for i in range(1, parts)]
    cuts = sorted(set(rows.agg(F.percentile_approx("doc", steps, 10_000)).first()[0] or [])) if steps else []
    bucket = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c <= F.col("doc"))) if cuts else F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    order = Window.orderBy("bucket")
    firsts = rows.groupBy("bucket").agg(F.min("doc").alias("doc"))  # one row a bucket
    to = F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    firsts = landed_small(firsts.withColumn("to", to))
    heads = rows.join(firsts, ["bucket", "doc"]).groupBy("to").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    ends = heads.select(F.col("to").alias("bucket"), F.lit(None).cast("long").alias("doc"), "text", F.lit(False).alias("own"))
    return rows.select("bucket", "doc", "text", F.lit(True).alias("own")).unionByName(ends)


def fingerprint_edits(docs: DataFrame, parts: int, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document, in one shuffle.

    ``doc, text, edited, hashes, edited_hashes, next_hashes``, a row for each row
    of ``docs``. Rows sort by doc_id (null last), then text; the last is followed
    by the first. Null texts are empty. Each bucket of neighbours is sorted by itself.
    """
    rows = in_buckets(docs, parts).withColumn("text", F.coalesce("text", F.lit("")))
    follow = Window.partitionBy("bucket").orderBy(F.col("own").desc(), "doc", "text")
    beside = with_anchors(rows, "text", "__at", "hashes", k, s).drop("__at").withColumns(
        {"__next": F.lead("text").over(follow), "next_hashes": F.lead("hashes").over(follow)}
    ).filter("own")
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - quarter), F.substring(F.col("__next"), F.lit(1), quarter))
    both = with_anchors(beside.withColumn("edited", edited), "edited", "__at", "edited_hashes", k, s)
    return both.select("doc", "text", "edited", "hashes", "edited_hashes", "next_hashes")
