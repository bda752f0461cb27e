"""Which posts to take: from which sources, and how many."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.plans.members import KeySet
from corpuslm.plans.numbering import number_rows

# Fixed value: how many posts are taken when the caller does not say.
DEFAULT_LIMIT = 25
# Up to here the last key is found by a top-k; above it keys are numbered without meeting in one task.
TOP_K = 1_000
# Share of the keys by which the bracket around the last one reaches to either side.
BRACKET = 0.005


def select_sources(posts: DataFrame, sources: Collection[str] | None, column: str = "source") -> DataFrame:
    """Posts of the given sources together; no sources means no restriction."""
    if not sources:
        return posts
    return posts.where(F.col(column).isin(*sorted(set(sources))))


def select_sources_of(
    posts: DataFrame, sources: DataFrame, column: str = "source", *, spread_by: str, keep: bool = True, **limits: int
) -> DataFrame:
    """Posts whose source stands in the first column of a table of any length; keep=False: the other posts.

    An empty table means no restriction, as no sources do. A post without a source is in no set.
    """
    chosen = KeySet(sources, **limits)
    if not chosen.n:
        return posts
    return (chosen.keep if keep else chosen.drop)(posts, column, spread_by)


def _up_to(last: Row, order: list[tuple[str, bool]]) -> Column:
    """Condition that a row does not come after `last`: nulls first ascending, last descending."""
    within = F.lit(True)
    for column, ascending in reversed(order):
        here, there = F.col(column), F.lit(last[column])
        closer = here < there if ascending else here > there
        null_first = here.isNull() & there.isNotNull() if ascending else here.isNotNull() & there.isNull()
        within = F.coalesce(closer, F.lit(False)) | null_first | (here.eqNullSafe(there) & within)
    return within


def _numbered(keys: DataFrame, order: list[tuple[str, bool]], wanted: int) -> Row | None:
    """The key at place `wanted`, counted from 1, or None where there are fewer.

    Approximate quantiles of the first column bracket it, an exact count says how many keys come before the
    bracket, and only what lies inside is numbered. A column without quantiles, or a bracket that
    misses, is numbered whole.
    """
    sort = [F.asc(c) if ascending else F.desc(c) for c, ascending in order]
    first, ascending = order[0]
    if isinstance(keys.schema[first].dataType, T.NumericType | T.DateType | T.TimestampType):
        total, known = keys.agg(F.count("*"), F.count(first)).first()
        # nulls come first ascending and last descending
        place = wanted - (total - known) if ascending else wanted
        if wanted <= total and 0 < place <= known:
            share = place / known if ascending else 1 - place / known
            ends = [max(0.0, share - BRACKET), min(1.0, share + BRACKET)]
            low, high = keys.agg(F.percentile_approx(first, ends, 10_000)).first()[0]
            before = F.col(first).isNull() | (F.col(first) < low) if ascending else F.col(first) > high
            skipped = keys.where(before).count()
            inside = keys.where(F.col(first).between(low, high))
            found = number_rows(inside, sort, "_n").where(F.col("_n") == wanted - 1 - skipped).first()
            if found is not None:
                return found
    return number_rows(keys, sort, "_n").where(F.col("_n") == wanted - 1).first()


def take_posts(
    posts: DataFrame, order: list[tuple[str, bool]], limit: int = DEFAULT_LIMIT, page: int = 1, top_k: int = TOP_K
) -> DataFrame:
    """The first posts in order, in whole pages: at least `limit` where there are so many.

    `order` lists (column, ascending) and must be total. The last key to take is found from the
    order columns alone; the posts then pass a filter, so that no text is sorted or moved.
    """
    wanted = -(-limit // page) * page
    keys = posts.select(*[c for c, _ in order])
    sort = [F.asc(c) if ascending else F.desc(c) for c, ascending in order]
    if wanted <= top_k:
        last = keys.orderBy(*sort).offset(wanted - 1).limit(1).first()
    else:
        last = _numbered(keys, order, wanted)
    return posts if last is None else posts.where(_up_to(last, order))
