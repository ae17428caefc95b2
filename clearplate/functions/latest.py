"""Winner per key, and neighbour look-ups that survive very long groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key.

    Spark turns ``row_number() <= k`` into a group limit on each map task before the
    shuffle, so a key holding most rows sends at most ``k`` rows per task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the key columns of ``left`` are kept."""
    marked = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = [left[k].eqNullSafe(marked[f"_r_{k}"]) for k in keys]
    return left.join(marked, condition, how).drop(*[f"_r_{k}" for k in keys])


def _blocked(df: DataFrame, position: str, block: int) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col(position) / block).cast("long"))


def carry_last(df: DataFrame, keys: Sequence[str], position: str, columns: dict[str, str], block: int = 10_000, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``out = last non-null value of column up to this row`` for each item of ``columns``.

    A group is cut into blocks of positions; each block is one small window, and
    only one row per block is passed on to the next. No task sees a whole long group.
    Rows of one position are ordered by ``tie``.
    """
    base = _blocked(df, position, block)
    inside = Window.partitionBy(*keys, "_block").orderBy(position, *tie).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    local = base.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(f"_local_{out}") for out, c in columns.items()])
    # Taken from the windowed rows, which lie together by block already: no second shuffle of the input.
    tails = local.groupBy(*keys, "_block").agg(*[F.max_by(f"_local_{out}", F.struct(position, *tie)).alias(f"_tail_{out}") for out in columns])
    tails = tails.select(
        *keys, "_block", *[F.last(f"_tail_{out}", ignorenulls=True).over(before).alias(f"_carry_{out}") for out in columns]
    )
    joined = join_null_safe(local, tails, [*keys, "_block"])
    return joined.select(
        *df.columns, *[F.coalesce(f"_local_{out}", f"_carry_{out}").alias(out) for out in columns]
    )


def neighbour(df: DataFrame, keys: Sequence[str], position: str, columns: dict[str, str], step: int, tie: Sequence[str] = (), block: int = 10_000) -> DataFrame:
    """Add the value of the previous (``step=-1``) or next (``step=1``) row of the group.

    Blocks as in :func:`carry_last`: within a block ``lag``/``lead``, across blocks the
    edge row of the nearest non-empty block.
    """
    base = _blocked(df, position, block)
    order = [position, *tie]
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    shift = F.lag if step < 0 else F.lead
    edge_pick = F.max_by if step < 0 else F.min_by
    edge = F.struct(*order)
    packed = F.struct(*[F.col(c).alias(out) for out, c in columns.items()])
    local = base.withColumn("_near", shift(packed).over(inside))
    edges = base.groupBy(*keys, "_block").agg(edge_pick(packed, edge).alias("_edge"))
    edges = edges.select(*keys, "_block", shift("_edge").over(Window.partitionBy(*keys).orderBy("_block")).alias("_edge"))
    joined = join_null_safe(local, edges, [*keys, "_block"])
    near = F.coalesce("_near", "_edge")
    return joined.select(*df.columns, *[near[out].alias(out) for out in columns])


def keep_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column and drop the rows in which it is NULL, computing it once.

    A plain filter on a computed column is pushed below it and repeats the whole
    expression; a filter on a generated column stays above.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name)).filter(F.col(name).isNotNull())
