"""Exact quantiles per group, whatever the size of a group.

Values are reduced to (group, value, count) rows, map-side. A group of more than
``large`` rows also has a quantile sketch, which Spark merges map-side: it tells
two values between which a wanted rank must lie. Values outside these brackets
are only counted, values inside (a few per ten thousand of the group's) are
listed, and the rank is found in the sorted list. No task holds more of a large
group than that list; the sketch only says where to look, the counts are exact,
and a bracket that missed its rank would be an error, never a wrong value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGE = 50_000    # rows of a group whose distinct values are listed as a whole
ACCURACY = 20_000  # the sketch's ranks are off by a share of 1 / ACCURACY at most
MARGIN = 4        # times that share, on both sides of a rank
SALTS = 32        # pieces into which a large group's values are dealt


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float], large: float = LARGE,
                    count: str | None = None, rows: str | None = None) -> DataFrame:
    """One row per group that has a value: for each (name, p) of ``wanted`` the observed value at rank ceil(p * n).

    NULL values are ignored, a NULL key is a group, NaN is larger than any
    other value. ``large`` changes no result. ``count`` names a bigint column
    for n, ``rows`` one for the rows with NULL values too; with ``rows`` a group
    of NULL values only has a row, with NULL quantiles.
    """
    keys = list(keys)
    given = (df if rows else df.where(F.col(value).isNotNull())).select(F.struct(*keys).alias("_group"), F.col(value).alias("_value"))
    # the sketch can't order NaN; it shares infinity's place there
    place = F.when(F.isnan(F.col("_value").cast("double")), F.lit(float("inf"))).otherwise(F.col("_value").cast("double"))
    values = given.groupBy("_group", "_value").agg(F.count(F.lit(1)).alias("_n")).withColumn("_place", place)

    slack = MARGIN / ACCURACY
    shares = [s for p in wanted.values() for s in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketched = (given.groupBy("_group").agg(F.count(F.lit(1)).alias("_rows"), F.percentile_approx(place, shares, ACCURACY).alias("_cuts"))
                .where(F.col("_rows") > F.lit(large)))
    # a struct of keys is never NULL itself, so NULL keys meet in an ordinary equi-join
    spread = sketched.select(F.col("_group").alias("_large"), "_cuts",
                             F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_piece"))
    dealt = values.withColumn("_salt", F.pmod(F.xxhash64("_value"), F.lit(SALTS)).cast("int"))
    some = F.col("_value").isNotNull()
    bracketed = dealt.join(spread, (F.col("_group") == F.col("_large")) & (F.col("_salt") == F.col("_piece")), "left")

    def cut(i: int) -> Column:
        return F.get("_cuts", F.lit(i))

    brackets = {name: (F.col("_cuts").isNotNull() & (F.col("_place") < cut(2 * i)),
                       F.col("_cuts").isNull() | ((F.col("_place") >= cut(2 * i)) & (F.col("_place") <= cut(2 * i + 1))))
                for i, name in enumerate(wanted)}
    item = F.struct("_value", "_n")
    found = bracketed.groupBy("_group").agg(
        F.coalesce(F.sum(F.when(some, F.col("_n"))), F.lit(0)).alias("_all"), F.sum("_n").alias("_rows"),
        *[F.coalesce(F.sum(F.when(below, F.col("_n"))), F.lit(0)).alias(f"_below_{name}") for name, (below, _) in brackets.items()],
        *[F.sort_array(F.collect_list(F.when(some & inside, item))).alias(f"_inside_{name}") for name, (_, inside) in brackets.items()])
    return found.select(*[F.col("_group")[k].alias(k) for k in keys],
                        *[F.col(c).cast("bigint").alias(name) for c, name in (("_all", count), ("_rows", rows)) if name],
                        *[_at_rank(F.ceil(F.col("_all") * F.lit(p)), F.col(f"_below_{name}"), F.col(f"_inside_{name}")).alias(name)
                          for name, p in wanted.items()])


def _at_rank(rank: Column, below: Column, inside: Column) -> Column:
    """The value in ``inside`` (sorted values with their counts) that the ``rank``-th of all is."""
    rank = F.greatest(rank, F.lit(1))

    def step(state: Column, item: Column) -> Column:
        upto = state["upto"] + item["_n"]
        hit = state["hit"].isNull() & (rank > state["upto"]) & (rank <= upto)
        return F.struct(upto.alias("upto"), F.when(hit, item["_value"]).otherwise(state["hit"]).alias("hit"))

    none = F.get(inside, F.lit(0))["_value"]
    start = F.struct(below.cast("bigint").alias("upto"), F.when(F.lit(False), none).alias("hit"))
    end = F.aggregate(inside, start, step)
    return F.when((F.size(inside) > 0) & end["hit"].isNull(), F.raise_error(F.lit("a quantile sketch has missed its rank"))).otherwise(end["hit"])
