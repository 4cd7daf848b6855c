"""Pages in the order that their tokens tell: each page names the next one.

The place of a page follows from how many come after it, which is found by pointer doubling: each
page knows the page some steps ahead and learns, from that one, the page twice as far. After as many
rounds as the longest chain has binary digits all pages have reached an end, and a page that has not
is part of a cycle. A round is one join on key and token, so a key with a third of all pages is
spread over the tasks like any other, and every round's rows are written before the next reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.operators.documents import PAGE_BLOCK, flatten_pages
from reelstat.operators.joins import match
from reelstat.session import removed, written


def chain_positions(
    pages: DataFrame, key: str, token: str, next_token: str, out: str = "page"
) -> DataFrame:
    """The pages with their zero-based place. The first page of a key has no token, the last one no
    next token.

    Raises ValueError if a token occurs twice in a key, a page is missing, or pages form a cycle.
    """
    links = written(pages.select(key, F.col(token).alias("_at"), F.col(next_token).alias("_next")), "links")
    _checked(links, key)
    # Steps to the end, and the page that is so many steps ahead, none if the end is reached.
    ahead = written(
        links.select(key, "_at", "_next", F.col("_next").isNotNull().cast("bigint").alias("_steps")), "steps"
    )
    longest = links.groupBy(key).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    rounds = 0
    while not ahead.filter(F.col("_next").isNotNull()).isEmpty():
        if rounds > longest.bit_length():
            raise ValueError("pages form a cycle")
        there = ahead.select(
            key, F.col("_at").alias("_next"), F.col("_next").alias("_far"), F.col("_steps").alias("_more")
        )
        live = match(ahead.filter(F.col("_next").isNotNull()), there, [key, "_next"])
        live = live.select(key, "_at", F.col("_far").alias("_next"), (F.col("_steps") + F.col("_more")).alias("_steps"))
        done = ahead.filter(F.col("_next").isNull())
        before, ahead = ahead, written(done.unionAll(live), "steps")
        removed(before)
        rounds += 1
    # Pages with a token that no page leads to would be the beginning of another chain.
    sizes = ahead.groupBy(key).agg(F.count("*").alias("_n"), F.max("_steps").alias("_last"))
    if not sizes.filter(F.col("_n") != F.col("_last") + 1).isEmpty():
        raise ValueError("pages that no other page leads to")
    placed = match(ahead, sizes.select(key, "_last"), [key]).select(
        key, F.col("_at").alias(token), (F.col("_last") - F.col("_steps")).alias(out)
    )
    return match(pages.drop(out), placed, [key, token])


def _checked(links: DataFrame, key: str) -> None:
    twice = links.groupBy(key, "_at").agg(F.count("*").alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError("a token names two pages")
    named = links.filter(F.col("_next").isNotNull()).select(key, F.col("_next").alias("_at"))
    if not match(named, links.select(key, "_at"), [key, "_at"], "left_anti").isEmpty():
        raise ValueError("a page is missing")


def flatten_chain(
    pages: DataFrame, key: str, token: str, next_token: str, ids: str, out: str = "videoId",
    block: int = PAGE_BLOCK,
) -> DataFrame:
    """The ids of all pages of a key, one row each, with their position in the whole list."""
    placed = chain_positions(pages, key, token, next_token, "_page")
    return flatten_pages(placed, key, "_page", ids, out, block)
