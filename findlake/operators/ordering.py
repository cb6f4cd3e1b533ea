"""Order-dependent building blocks that hold when one group has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from findlake.session import materialize_ranges, shuffle_partitions

SALTS = 16
MOST_SALTS = 4096
# Rows from which on a key is hot, where they are counted.
HOT_ROWS = 10_000


def salts_for(df: DataFrame) -> int:
    """Salts that follow the data: one for every eight partitions that the session starts a shuffle
    with (see ``build_session``), 16 at least. Results do not depend on the number."""
    return min(MOST_SALTS, max(SALTS, shuffle_partitions(df.sparkSession) // 8))


def first_by(df: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The row with the lowest ``order`` of each key.

    ``row_number() = 1`` makes Spark cut every group to one row per task before the shuffle
    (WindowGroupLimit), so a hot key sends one row per map task, not all its copies. A hash of the key is
    sorted by before the key: the sort holds its first eight bytes beside each row, and those of texts
    that begin alike would send it to the rows themselves at every comparison.
    """
    w = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, out: str = "n") -> DataFrame:
    """The first ``n`` rows of each key, numbered from 1. Groups are cut before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def numbered(
    df: DataFrame,
    group: Sequence[str],
    order: str = "seq",
    out: str = "n",
    ties: Sequence[str] = (),
    first: str | None = None,
) -> DataFrame:
    """Exact 1-based row numbers in ``group`` by ``order``, and the group's lowest ``order`` as
    ``first`` if that is named; without one task per group.

    ``order`` and ``ties`` are unique within a group. The rows are written once, in ranges of (group,
    order); this is the only time they are shuffled. A window numbers the rows of each group within
    its range, which needs no exchange (see ``materialize_ranges``). Only a range that starts within a
    group has rows of it before: for those, one row a range at most, the sizes of the group's
    earlier ranges are added up and broadcast.
    """
    group = list(group)
    table = materialize_ranges(df, "numbered", [*group, order, *ties], "_part")
    here = Window.partitionBy("_part", *group).orderBy(order, *ties)
    rows = table.withColumns({"_n": F.row_number().over(here), "_low": F.first(order).over(here)})
    cells = table.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_rows"), F.min(order).alias("_least"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(
        F.col("_part").alias("_of"),
        *[F.col(g).alias(f"_{g}") for g in group],
        F.sum("_rows").over(earlier).alias("_before"),
        F.min("_least").over(earlier).alias("_lowest"),
    ).where("_before IS NOT NULL")
    same = F.col("_part") == F.col("_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = rows.join(F.broadcast(before), same, "left")
    number = (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("bigint")
    lowest = [] if first is None else [F.coalesce("_lowest", "_low").alias(first)]
    return joined.select(*df.columns, number.alias(out), *lowest)


def frequent(rows: DataFrame, on: Sequence[str], least: int = HOT_ROWS) -> DataFrame:
    """(``_hot``): hashes of the keys that ``least`` rows or more have, for ``hot_join``. There is one for
    every ``least`` rows at most; only hashes and counts are shuffled."""
    counts = rows.select(F.xxhash64(*on).alias("_hot")).groupBy("_hot").agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") >= least).select("_hot")


def hot_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    spread_by: Sequence[str] = ("seq",),
    salts: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join rows to a small-per-key side when one key may own a third of the left rows.

    The left rows of a key are spread over ``salts`` tasks by a hash of ``spread_by`` (stable
    under re-runs), and the right side, one row per key, is repeated once per salt. It is never
    broadcast: Spark would go by its size before it is repeated, or after compression, which hides
    the copies, and the driver would hold them all. Where the right side is as large as the left one, give
    the left keys that are ``hot`` (see ``frequent``): only their rows are spread and repeated, and only
    their hashes are sent to every executor. A row more or less there never changes the result.
    """
    on = list(on)
    salts = salts or salts_for(left)
    salt, repeated = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"), F.sequence(F.lit(0), F.lit(salts - 1))
    columns = left.columns, right.columns
    if hot is not None:
        known = F.broadcast(hot.withColumn("_spread", F.lit(True)))
        left, right = (side.withColumn("_hot", F.xxhash64(*on)).join(known, "_hot", "left") for side in (left, right))
        salt, repeated = F.when(F.col("_spread"), salt).otherwise(0), F.when(F.col("_spread"), repeated).otherwise(F.array(F.lit(0)))
    salted_left = left.select(*columns[0], salt.alias("_salt"))
    salted_right = right.select(*columns[1], F.explode(repeated).alias("_salt"))
    return salted_left.join(salted_right.hint("merge"), [*on, "_salt"], how).drop("_salt")
