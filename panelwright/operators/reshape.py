"""Wide to long and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import as_column, first_chars, row_total
from panelwright.operators.clean import assert_unique

ID_LENGTH = 12


def to_long(
    df: DataFrame,
    ids,
    values=None,
    variable: str = "variable",
    value: str = "value",
    cast: str | None = None,
) -> DataFrame:
    """One row per id and value column, nulls kept.

    Columns of different types need a common one: pass `cast`.
    """
    ids = list(ids)
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    if cast:
        df = df.select(*ids, *[F.col(c).cast(cast).alias(c) for c in values])
    return df.unpivot(ids, values, variable, value)


def to_wide(
    df: DataFrame,
    index,
    column: str,
    value: str,
    names: dict,
    agg: str = "only",
    check: bool | str = True,
    rest: str | None = None,
) -> DataFrame:
    """One row per index, one column per category in `names` ({category: name}).

    Rows of categories not in `names`, a missing one included, go to the column
    `rest` (with agg 'count' or 'sum'); without `rest` they are an error when the
    result is computed.

    agg 'only' takes the single value of a cell (and, with `check`, raises if
    (index, column) repeats); 'count' counts known values and 'sum' adds them.
    An absent cell is null. All cells are filled in one aggregation. With
    check='late' repeated cells are counted in that aggregation too, and are an
    error when the result is computed: nothing runs beforehand.
    """
    index = list(index)
    if check not in (True, False, "late"):
        raise ValueError(f"check must be True, False or 'late', not {check!r}")
    late = agg == "only" and check == "late"
    if agg == "only" and check is True:
        assert_unique(df, [*index, column], "long table")
    x = F.col(value)

    listed = F.coalesce(F.col(column).isin(list(names)), F.lit(False))

    def cell(here):
        if agg == "only":
            return F.max(F.when(here, x))
        if agg == "count":
            return F.sum(F.when(here, x.isNotNull().cast("long")))
        if agg == "sum":
            return F.sum(F.when(here, x))
        raise ValueError(f"unknown aggregate {agg!r}")

    cells = [cell(F.col(column) == F.lit(c)).alias(n) for c, n in names.items()]
    if rest:
        if agg == "only":
            raise ValueError("several categories have no single value: count or add them")
        return df.groupBy(*index).agg(*cells, cell(~listed).alias(rest))
    copies = [F.count_if(F.col(column) == F.lit(c)).alias(f"__n{i}") for i, c in enumerate(names)] if late else []
    wide = df.groupBy(*index).agg(*cells, F.count_if(~listed).alias("__rest"), *copies)
    unlisted = F.raise_error(F.lit(f"{column} has categories that no column is named for"))
    repeated = F.raise_error(F.lit(f"long table: key ({', '.join([*index, column])}) is repeated"))

    def checked(i, name):
        cell = F.when(F.col(f"__n{i}") > 1, repeated).otherwise(F.col(name)) if late else F.col(name)
        return F.when(F.col("__rest") > 0, unlisted).otherwise(cell).alias(name)

    return wide.select(*index, *[checked(i, n) for i, n in enumerate(names.values())])


def found_categories(df: DataFrame, column: str, most: int = 100, prefix: str = "") -> dict:
    """{category: column name} of the known categories of a column, in order; an error if there are over `most`.

    Only that column is read. The result is a key set with a bound, not data: a column that holds something else
    than categories fails here, before anything is widened.
    """
    values = sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect())
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} categories")
    names = {v: f"{prefix}{v}" for v in values}
    if len(set(names.values())) < len(names):
        raise ValueError(f"categories of {column} share a name")
    return names


def to_wide_found(
    df: DataFrame,
    index,
    column: str,
    value: str,
    agg: str = "only",
    most: int = 100,
    prefix: str = "",
    rest: str | None = None,
) -> DataFrame:
    """`to_wide` with a column for every category that the data hold.

    Two passes: the categories alone, then one aggregation with one shuffle of partial results. Rows without a
    category go to the column `rest`, or are an error when the result is computed; so is a repeated cell of 'only'.
    """
    names = found_categories(df, column, most, prefix)
    taken = set(names.values()) & {*index, *([rest] if rest else [])}
    if taken:
        raise ValueError(f"categories named like other columns: {sorted(taken)}; pass a prefix")
    return to_wide(df, index, column, value, names, agg, "late", rest)


def header_id(df: DataFrame, variable: str = "variable", name: str = "isin") -> DataFrame:
    """The firm id at the start of a sheet's column header."""
    return df.withColumn(name, first_chars(variable, ID_LENGTH))


def with_total(df: DataFrame, cols, name: str = "total") -> DataFrame:
    return df.withColumn(name, row_total(*[as_column(c) for c in cols]))
