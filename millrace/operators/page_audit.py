"""Audit landed pages: which end-rule closed each walk, and is it whole?

Input: one row per landed page with ``endpoint``, ``page`` (1, 2, ...) and the
page's JSON ``body``.  Every rule looks at single pages; only the cursor rule
needs the page before, which it fetches by an equi-join on (endpoint, page), so
an endpoint with a third of all pages is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payloads as P
from ..sinks.files import settled

STOP = "stop"
#: One in so many cursors of a chain is a place to stop at.
STRIDE = 16


def _body() -> Column:
    return F.try_parse_json(F.col("body"))


def cursor_rule(pages: DataFrame, pointer: str) -> DataFrame:
    """Ends when the next cursor is absent, or repeats the one before."""
    marked = pages.withColumn("__next", P.dotted(F.col("body"), pointer))
    before = marked.select("endpoint", (F.col("page") + 1).alias("page"), F.col("__next").alias("__before"))
    joined = marked.join(before, ["endpoint", "page"], "left")
    stop = (F.when(F.col("__next").isNull(), F.lit("no_cursor"))
            .when(F.col("__next") == F.col("__before"), F.lit("stuck_cursor")))
    return joined.withColumn(STOP, stop).drop("__next", "__before")


def short_page_rule(pages: DataFrame, path: Sequence[str], limit: int) -> DataFrame:
    """Ends on a page with fewer than ``limit`` records, or one that cannot be read."""
    n = F.size(P.as_list(_body(), path))
    stop = F.when(F.coalesce(n, F.lit(-1)) < 0, F.lit("unreadable")).when(n < limit, F.lit("short_page"))
    return pages.withColumn(STOP, stop)


def link_rule(pages: DataFrame, header: str, base_url: str) -> DataFrame:
    """Ends when the Link header has no ``rel="next"``, or it leads off the base URL."""
    url = F.regexp_extract(F.coalesce(F.col(header), F.lit("")),
                           r'(?i)<([^>]+)>\s*;[^,]*?\brel\s*=\s*"?\s*next\b', 1)
    stop = (F.when(url == "", F.lit("no_link"))
            .when(~url.startswith(base_url), F.lit("off_origin")))
    return pages.withColumn(STOP, stop)


def has_more_rule(pages: DataFrame) -> DataFrame:
    """Ends on no ``data`` list, an empty one, ``has_more`` false, or a last item without id."""
    data = P.as_list(_body(), ["data"])
    n = F.size(data)
    more = P.get(_body(), ["has_more"], "boolean")
    last_id = P.get(F.try_element_at(data, F.lit(-1)), ["id"])
    stop = (F.when(data.isNull(), F.lit("no_data"))
            .when(n == 0, F.lit("empty_page"))
            .when(~F.coalesce(more, F.lit(False)), F.lit("no_more"))
            .when(last_id.isNull(), F.lit("no_id")))
    return pages.withColumn(STOP, stop)


def page_info_rule(pages: DataFrame, path: Sequence[str]) -> DataFrame:
    """Ends when ``hasNextPage`` is false or ``endCursor`` is missing."""
    more = P.get(_body(), [*path, "hasNextPage"], "boolean")
    cursor = F.nullif(P.get(_body(), [*path, "endCursor"], "string"), F.lit(""))
    stop = (F.when(~F.coalesce(more, F.lit(False)), F.lit("last_page"))
            .when(cursor.isNull(), F.lit("no_cursor")))
    return pages.withColumn(STOP, stop)


def walk_report(ruled: DataFrame, page_cap: int | None = None) -> DataFrame:
    """Per endpoint: pages landed, the page and rule that ended the walk, and a verdict.

    ``gap``: a page number is missing.  ``overrun``: pages follow the end.
    ``capped``: the page cap was reached.  ``truncated``: no end-rule fired.
    """
    ended = F.when(F.col(STOP).isNotNull(), F.struct("page", STOP))
    walk = ruled.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("pages"), F.min("page").alias("__first"),
        F.max("page").alias("last_page"), F.min(ended).alias("__end"))
    whole = (F.col("__first") == 1) & (F.col("pages") == F.col("last_page"))
    end_page = F.col("__end.page")
    verdict = (F.when(~whole, F.lit("gap"))
               .when(end_page == F.col("last_page"), F.lit("complete"))
               .when(end_page < F.col("last_page"), F.lit("overrun")))
    if page_cap is not None:
        verdict = verdict.when(F.col("last_page") >= page_cap, F.lit("capped"))
    return walk.select("endpoint", "pages", "last_page", end_page.alias("end_page"),
                       F.col(f"__end.{STOP}").alias("end_rule"),
                       verdict.otherwise(F.lit("truncated")).alias("verdict"))


def chain_report(pages: DataFrame) -> DataFrame:
    """Pages without numbers, ordered by their cursors: per endpoint, how the chain of pages hangs together.

    Rows are ``endpoint``, ``cursor`` (what the page was asked with; NULL for the first) and ``next`` (what it
    offers).  ``in_order`` pages follow from the first one, ``length`` of the longest such walk; ``breaks`` are offers that no page took up;
    ``forks`` are cursors that several pages offer or were asked with; ``orphans`` follow from a page that no page offers; ``cyclic`` pages
    follow from a page that comes round again.

    Every cursor points at the one that offered it.  Cursors chosen by hash, one in ``STRIDE``, are stops: first all pointers jump
    as far as they have come until they stand at a stop or at the start of a walk, which takes a few rounds, however long the
    walks are; then only the stops jump on.  A pointer that is still on its way after as many rounds as the endpoint's
    pages need is in a cycle, or hangs on one.  Rounds move three numbers a cursor; its text is compared once.
    """
    page = settled(pages.select("endpoint", "cursor", "next").where("endpoint IS NOT NULL"), "pages")
    asked = page.select("endpoint", "cursor", F.lit(1).alias("n"), F.lit(0).alias("offers"), F.lit(None).cast(
        f"struct<later: boolean, cursor: {dict(page.dtypes)['cursor']}>").alias("by"))
    offered = page.where("next IS NOT NULL").select("endpoint", F.col("next").alias("cursor"), F.lit(0).alias("n"), F.lit(1).alias("offers"), F.struct(
        F.col("cursor").isNotNull().alias("later"), "cursor").alias("by"))
    cursors = settled(asked.unionByName(offered).groupBy("endpoint", "cursor").agg(F.sum("n").alias("n"), F.sum("offers").alias("offers"), F.min("by").alias("by"))
                      .withColumn("id", F.monotonically_increasing_id()), "cursors")
    # where a walk starts there is nothing to point at; the first page's cursor is NULL
    nodes = cursors.where("n > 0")
    start = F.col("by").isNull()
    first = F.when(start, F.col("cursor").isNull())
    starts = nodes.where(start).select("id", F.col("id").alias("at"), F.lit(0).cast("bigint").alias("hops"), first.alias("first"))
    later = nodes.where(~start).select("id", "endpoint", F.col("by.cursor").alias("cursor"))
    to = nodes.select("endpoint", "cursor", F.col("id").alias("at"), first.alias("first"))
    same = (later["endpoint"] == to["endpoint"]) & later["cursor"].eqNullSafe(to["cursor"])
    state = starts.unionByName(later.join(to, same).select("id", "at", F.lit(1).cast("bigint").alias("hops"), "first"))
    most = nodes.groupBy("endpoint").count().agg(F.max("count")).first()[0] or 0
    rounds = max(most, 1).bit_length()
    state = _jumped(state, ~_stop(F.col("at")), rounds)
    stops = _jumped(state.where(_stop(F.col("id"))), F.lit(True), rounds)
    ahead = stops.select(F.col("id").alias("at"), F.col("hops").alias("__hops"), F.col("first").alias("__first"))
    reached = state.where("first IS NULL").join(ahead, "at", "left").select(
        "id", (F.col("hops") + F.coalesce("__hops", F.lit(0))).alias("hops"), F.col("__first").alias("first")).unionByName(
        state.where("first IS NOT NULL").select("id", "hops", "first"))
    reached = cursors.join(reached, "id", "left")
    in_order, asked = F.col("first"), F.col("n") > 0
    return reached.groupBy("endpoint").agg(
        F.sum("n").alias("pages"), F.sum(F.when(in_order, F.col("n")).otherwise(0)).alias("in_order"),
        F.coalesce(F.max(F.when(in_order, F.col("hops") + 1)), F.lit(0)).alias("length"),
        F.sum(F.when(asked, 0).otherwise(F.col("offers"))).alias("breaks"),
        F.count_if(asked & ((F.col("n") > 1) | (F.col("offers") > 1))).alias("forks"),
        F.sum(F.when(~in_order, F.col("n")).otherwise(0)).alias("orphans"),
        F.sum(F.when(in_order.isNull(), F.col("n")).otherwise(0)).alias("cyclic"))


def _stop(node: Column) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(STRIDE)) == 0


def _jumped(state: DataFrame, on: Column, rounds: int) -> DataFrame:
    """Rows (id, at, hops, first) after as many jumps as it takes; ``first`` is NULL until a pointer stands at the start of a walk, and only
    pointers with ``on`` go on."""
    for _ in range(rounds):
        state = settled(state, "chain")
        moving = F.col("first").isNull() & on
        left = state.where(moving)
        if left.isEmpty():
            return state
        ahead = state.select(F.col("id").alias("at"), F.col("at").alias("__at"), F.col("hops").alias("__hops"), F.col("first").alias("__first"))
        state = state.where(~moving).unionByName(left.join(ahead, "at", "left").select(
            "id", F.coalesce("__at", "at").alias("at"), (F.col("hops") + F.coalesce("__hops", F.lit(0))).alias("hops"), F.col("__first").alias("first")))
    return settled(state, "chain")
