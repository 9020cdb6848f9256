"""Page discovery and the choice of what to process next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from switchback import fixed_values as V
from switchback.functions.values import strip


def _no_slash(c: Column) -> Column:
    return F.regexp_replace(c, "/+$", "")


def filter_urls(urls: DataFrame, contains: str = V.HIKE_PATH, not_suffix: str = V.VIEW_SUFFIX) -> DataFrame:
    """Keep detail pages; drop those whose address ends in ``not_suffix``, trailing slashes aside."""
    return urls.filter(F.contains("url", F.lit(contains)) & ~F.endswith(_no_slash(F.col("url")), F.lit(not_suffix)))


#: Comments and elements whose content is not markup.
_NO_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<textarea\b.*?</textarea\s*>"
#: The href of an ``a`` element in any quoting; quoted values of attributes before it are passed over whole.
_ANCHOR = r"""(?is)<a(?:\s|\s(?:[^>"']|"[^"]*"|'[^']*')*?\s)href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_ENTITIES = {"&quot;": '"', "&#34;": '"', "&apos;": "'", "&#39;": "'", "&lt;": "<", "&gt;": ">", "&nbsp;": "\u00a0", "&#38;": "&", "&amp;": "&"}


def anchor_targets(html: Column) -> Column:
    """Targets of all ``a`` elements in order, entities decoded: array<string>."""
    found = F.regexp_extract_all(F.regexp_replace(html, _NO_MARKUP, " "), F.lit(_ANCHOR), F.lit(1))

    def plain(v: Column) -> Column:
        v = F.regexp_replace(v, r"""^["']|["']$""", "")
        for entity, sign in _ENTITIES.items():  # the ampersand itself last
            v = F.replace(v, F.lit(entity), F.lit(sign))
        return strip(v)

    return F.transform(found, plain)


def harvest_links(
    pages: DataFrame, base: str, marker: str = V.HIKE_PATH, page_no: str = "page_no", html: str = "html"
) -> DataFrame:
    """Distinct absolute detail links of list pages, with the place each was first seen: (url, page_no, pos).

    The index page itself is skipped before query and fragment are cut. The
    minimum per link combines on the map side, so a link on every page is cheap.
    """
    hrefs = pages.select(page_no, F.posexplode(anchor_targets(F.col(html))).alias("pos", "_h"))
    index = marker.rstrip("/")
    wanted = F.contains("_h", F.lit(marker)) & ~F.endswith("_h", F.lit(marker))
    if index:
        wanted = wanted & ~F.endswith("_h", F.lit(index))
    full = F.when(F.startswith("_h", F.lit("http")), F.col("_h")).otherwise(F.concat(F.lit(base), F.col("_h")))
    bare = _no_slash(F.regexp_replace(F.regexp_replace(full, r"(?s)#.*$", ""), r"(?s)\?.*$", ""))
    first = hrefs.filter(wanted).select(bare.alias("url"), page_no, "pos").groupBy("url")
    return first.agg(F.min(F.struct(page_no, "pos")).alias("_at")).select("url", "_at.*")


def page_offset(page: Column, size: int = V.LIST_PAGE_SIZE) -> Column:
    """Offset of a 1-based list page."""
    return (page - 1) * F.lit(size)


def page_offsets(spark: SparkSession, start: int, n: int, size: int = V.LIST_PAGE_SIZE) -> DataFrame:
    first = max(1, start)
    return spark.range(first, first + n).select(
        F.col("id").alias("page"), page_offset(F.col("id"), size).alias("offset")
    )


def slug(url: Column) -> Column:
    return F.element_at(F.split(_no_slash(url), "/"), -1)


def slug_id(url: Column, prefix: str = V.ID_PREFIX) -> Column:
    return F.concat(F.lit(prefix), slug(url))


def slug_title(url: Column) -> Column:
    return F.initcap(F.replace(slug(url), F.lit("-"), F.lit(" ")))


def lookup_state(urls: DataFrame, state: DataFrame) -> DataFrame:
    """Every requested address with its stored state, in one join."""
    return urls.join(state.withColumn("known", F.lit(True)), "url", "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def select_frontier(urls: DataFrame, state: DataFrame, k: int | None, pos: str = "pos") -> DataFrame:
    """The ``k`` pages to process: never seen ones in listing order, then the longest unseen.

    ``k`` is the politeness bound of a run (tens to hundreds), so the plan is a
    distributed top-k, not a sort. None takes all, unsorted.
    """
    ranked = lookup_state(urls.select(pos, "url"), state.select("url", "last_crawled_at"))
    if k is None:
        return ranked
    return ranked.orderBy("known", F.col("last_crawled_at").asc_nulls_first(), pos).limit(k)


def frontier_stats(urls: DataFrame, state: DataFrame) -> DataFrame:
    """(listed, known_urls, never): listed rows, distinct addresses with a state row, rows without one."""
    found = lookup_state(urls.select("url"), state.select("url"))
    return found.agg(
        F.count(F.lit(1)).alias("listed"),
        F.count_distinct(F.when(F.col("known"), F.col("url"))).alias("known_urls"),
        F.count_if(~F.col("known")).alias("never"),
    )


def remaining(stats: DataFrame, crawled: DataFrame) -> DataFrame:
    """How many never-seen addresses are left once ``crawled`` rows are done."""
    left = stats.select(F.col("never").cast("bigint").alias("n"))
    done = crawled.agg((-F.count(F.lit(1))).alias("n"))
    return left.union(done).agg(F.greatest(F.lit(0).cast("bigint"), F.sum("n")).alias("remaining_uncrawled"))


def dedupe_first(df: DataFrame, key: str, order: str, limit: int | None = None) -> DataFrame:
    """First row per key in ``order``, NULLs last and ties by content; with ``limit``, the first so many of those.

    An aggregate, so copies combine before the shuffle and a key with many
    copies does not end up in one task.
    """
    payload = [c for c in df.columns if c != key]
    content = F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})
    place = F.struct(F.col(order).isNull().alias("missing"), F.col(order).alias("order"), content.alias("content"))
    kept = df.groupBy(key).agg(F.min_by(F.struct(*payload), place).alias("_r")).select(key, "_r.*")
    kept = kept.select(*df.columns)
    return kept if limit is None else kept.orderBy(F.col(order).asc_nulls_last(), key).limit(limit)


def take_first(df: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` rows; each task keeps its own first ``n`` and one task merges them, so ``n`` is meant to be small (thousands)."""
    return df.orderBy(order).limit(n)
