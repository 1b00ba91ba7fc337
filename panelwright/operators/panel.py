"""Lags, returns, compounding, filling and indexes on entity-time panels.

A panel has one row per entity and time (see `clean.dedupe`). On a calendar of
days or months a window over one entity is therefore bounded by the length of
the calendar, however many raw rows the entity had. Where time is finer than
that, pass `block`, a width on the time axis: an entity is then split into
blocks that run in separate tasks, and the few rows a block needs from its
neighbours are carried over. `block="ranges"` guesses no width: the rows are dealt
into ranges of equal counts and written once, which suits a series without any
entity (`entity=[]`), and entities that are missing or hold very many rows. All
ways give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions import growth
from panelwright.operators import ranges
from panelwright.operators.tables import attach, freeze, running_total

CHUNK_ROWS = 100_000


def _block_of(df: DataFrame, t: str, block) -> Column:
    """Block number of a time: `block` counts days for dates and timestamps."""
    dated = isinstance(df.schema[t].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    time = F.unix_date(F.to_date(t)) if dated else F.col(t)
    return F.floor(time / F.lit(block)).cast("long")


def _part(df: DataFrame, entity, t: str, block) -> Column:
    """Entity and block as one key.

    A struct is never null and equals another field by field, nulls included, so
    the same column serves windows, aggregates and joins with one shuffle.
    """
    return F.struct(*entity, _block_of(df, t, block).alias("__block"))


def _split(df: DataFrame, entity, order, block) -> DataFrame:
    """`df` with entity and block as __part."""
    if block == "ranges":
        rows = ranges.dealt(df, entity, order, "__block")
        return rows.withColumn("__part", F.struct(*entity, "__block")).drop("__block")
    return df.withColumn("__part", _part(df, entity, order[0], block))


def _entity_of_part(entity) -> list[Column]:
    return [F.col("__part").getField(e) for e in entity]


def numbered(df: DataFrame, entity, order, block=None, name: str = "row") -> DataFrame:
    """Position 1, 2, ... of each row within its entity."""
    entity, order = list(entity), list(order)
    if block is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*entity).orderBy(*order)).cast("long"))
    if block == "ranges":
        return ranges.numbered(df, entity, order, name)
    split = df.withColumn("__part", _part(df, entity, order[0], block))
    earlier = W.partitionBy(*_entity_of_part(entity)).orderBy("__part.__block")
    sizes = split.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    sum_before = F.sum("__size").over(earlier.rowsBetween(W.unboundedPreceding, -1))
    before = sizes.select("__part", F.coalesce(sum_before, F.lit(0)).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order))
    return (
        split.join(before, "__part")
        .withColumn(name, inside + F.col("__before"))
        .drop("__part", "__before")
    )


def _looking_back(df: DataFrame, entity, order, lookback: int, block, build, position: str | None = None):
    """Apply window columns that look back at most `lookback` rows.

    `build(window)` returns {name: Column}. In blocks, rows are numbered within
    their entity and cut into chunks; the last `lookback` rows of a chunk are
    also sent to the next chunk, where they serve as history and are dropped.
    `position` names a column that `numbered` has already added.
    """
    entity, order = list(entity), list(order)
    if block is None:
        return df.withColumns(build(W.partitionBy(*entity).orderBy(*order)))
    size = max(CHUNK_ROWS, 10 * lookback)
    chunk = F.floor(F.col("__row") / size).cast("long")
    repeated = F.col("__row") % size >= size - lookback
    rows = df.withColumn("__row", F.col(position)) if position else numbered(df, entity, order, block, "__row")
    rows = rows.withColumn(
        "__chunk", F.explode(F.when(repeated, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))
    ).withColumn("__own", F.col("__chunk") == chunk)
    done = rows.withColumns(build(W.partitionBy(*entity, "__chunk").orderBy("__row")))
    return done.filter("__own").drop("__row", "__chunk", "__own")


def lag_rows(df: DataFrame, entity, order, cols, steps=(1,), block=None, position: str | None = None) -> DataFrame:
    """Add lag{i}_{col}, the value i rows earlier in the entity, for each i in `steps`.

    `position` names a column with the rows' positions, which blocks then need not find again.
    """
    cols, steps = ([cols] if isinstance(cols, str) else list(cols)), list(steps)

    def build(w):
        return {f"lag{i}_{c}": F.lag(c, i).over(w) for c in cols for i in steps}

    return _looking_back(df, entity, order, max(steps), block, build, position)


def lag_if_adjacent(
    df: DataFrame, entity, t: str, cols, step: int = 1, gap: str | None = None, block=None, prefix: str = "lag_"
) -> DataFrame:
    """Add the previous value of each column, known only if time moved by `step`.

    `t` is a whole number such as a month or calendar index. `gap` names a column for the time difference to the previous row.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)

    def build(w):
        moved = F.col(t) - F.lag(t).over(w)
        out = {prefix + c: F.when(moved == step, F.lag(c).over(w)) for c in cols}
        return {**out, gap: moved} if gap else out

    return _looking_back(df, entity, [t], 1, block, build)


def adjacent_return(
    df: DataFrame, entity, t: str, price: str, name: str = "ret", gap: str | None = None, step: int = 1, block=None
) -> DataFrame:
    """Simple return on the previous period, null across a gap in time."""
    lagged = lag_if_adjacent(df, entity, t, price, step, gap, block, prefix="__lag_")
    return lagged.withColumn(name, growth(price, f"__lag_{price}")).drop(f"__lag_{price}")


def compound(
    df: DataFrame, entity, order, ret: str, window: int, name: str = "hpr", block=None
) -> DataFrame:
    """Compounded return over the last `window` rows, all of them required.

    A null in the window gives null, a return below -100% gives null, a return
    of exactly -100% gives -1.
    """
    r = F.col(ret)

    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        enough = F.count(r).over(frame) == window
        lowest = F.min(1 + r).over(frame)
        total = F.sum(F.when(1 + r > 0, F.ln(1 + r))).over(frame)
        value = F.when(lowest == 0, -1.0).when(lowest > 0, F.exp(total) - 1)
        return {name: F.when(enough, value)}

    return _looking_back(df, entity, order, window - 1, block, build)


def backfill(df: DataFrame, entity, order, cols, block=None) -> DataFrame:
    """Replace nulls by the next known value of the entity in `order`.

    `order` should identify a row within its entity; with `block` its first
    column is the time. A fill may reach over any distance, so blocks exchange
    the first known value of every later block. The windows run from the end, for
    Spark reads a frame that ends with the partition anew for every row.
    """
    entity, order = list(entity), list(order)
    cols = [cols] if isinstance(cols, str) else list(cols)
    backward = [F.desc(c) for c in order]
    behind = (W.unboundedPreceding, W.currentRow)
    if block is None:
        w = W.partitionBy(*entity).orderBy(*backward).rowsBetween(*behind)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    split = _split(df, entity, order, block)
    later = W.partitionBy(*_entity_of_part(entity)).orderBy(F.desc("__part.__block"))
    later = later.rowsBetween(W.unboundedPreceding, -1)
    key = F.struct(*order)
    firsts = split.groupBy("__part").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), key)).alias(f"__{c}") for c in cols]
    )
    nexts = firsts.select(
        "__part", *[F.last(f"__{c}", ignorenulls=True).over(later).alias(f"__{c}") for c in cols]
    )
    inside = W.partitionBy("__part").orderBy(*backward).rowsBetween(*behind)
    local = split.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in cols})
    return local.join(nexts, "__part").select(
        *[F.coalesce(c, f"__{c}").alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def dense_index(df: DataFrame, col: str, name: str) -> DataFrame:
    """Table of the distinct known values of `col`, numbered 1, 2, ... in order."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("__one", F.lit(1))
    return running_total(values, col, "__one", name).drop("__one")


def with_dense_index(df: DataFrame, col: str, name: str, source: DataFrame | None = None) -> DataFrame:
    """Add the position of `col` among its distinct values; nulls get none.

    `source` is a cheaper table known to hold the same values of `col`.
    """
    index = freeze(dense_index(df if source is None else source, col, name))
    index = index.withColumnRenamed(col, "__value")
    return df.join(index, F.col(col) == F.col("__value"), "left").drop("__value")


def with_group_stats(df: DataFrame, keys, **aggregates: Column) -> DataFrame:
    """Add group aggregates to every row of the group."""
    keys = list(keys)
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    return attach(df, stats, keys)


def gap_counts(df: DataFrame, entity, t: str, block=None) -> DataFrame:
    """How often each time step between neighbouring rows of an entity occurs."""
    stepped = lag_if_adjacent(df.select(*entity, t), entity, t, [], gap="gap", block=block)
    return stepped.filter(F.col("gap").isNotNull()).groupBy("gap").agg(F.count(F.lit(1)).alias("n"))
