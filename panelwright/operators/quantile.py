"""Exact percentiles without gathering a group in one task."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import finite
from panelwright.operators.tables import attach, freeze

# Position of fraction p among n sorted values; p and the position are whole numbers of 1 / SCALE.
# linear   interpolates between the ranks around (n - 1) p + 1
# weibull  interpolates between the ranks around (n + 1) p
# averaged takes the next rank above n p, or the mean of two ranks if n p is whole
SCALE = 10**17  # as fine as a double between 0.1 and 1
POSITION = {"linear": f"(n - 1) * p + {SCALE}", "weibull": "(n + 1) * p", "averaged": "n * p"}

PARTS = 256  # pieces of equal width that a bracket is cut into, each one row of counts


def percentiles(
    df: DataFrame,
    cols,
    fractions,
    by=(),
    definition: str = "linear",
    accuracy: int = 10_000,
) -> DataFrame:
    """Exact percentiles of `cols` per group: by..., variable, fraction, value.

    First a mergeable sketch per group brackets every requested rank between two
    cut values. Then one aggregation counts the rows between cuts exactly and
    keeps distinct values with their counts only inside the brackets, about
    4 / accuracy of the rows; a bracket is cut into pieces of equal width, each
    one row of counts. The pieces' sizes, some thousand numbers a group, tell
    which piece holds a rank, and the value is read from that piece alone. A rank
    further than one beside its bracket is an error.

    The rows are read twice; freeze a costly input first.
    """
    fractions = sorted(set(fractions))
    groups, ranked = with_percentiles(df, cols, fractions, by, definition, accuracy)
    cols, by = ([cols] if isinstance(cols, str) else list(cols)), list(by)
    each = groups.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("variable")) for c in cols])))
    listed = [F.struct(F.lit(float(p)).alias("fraction"), _value(i).alias("value")) for i, p in enumerate(fractions)]
    return attach(each, ranked, [*by, "variable"], "left").select(*by, "variable", F.inline(F.array(*listed)))


def _value(i: int):
    return F.col("__values").getItem(i)


def percentile_columns(df: DataFrame, cols, names: dict, by=(), definition: str = "linear") -> DataFrame:
    """Percentiles as columns, one row per group: `names` maps a fraction to a prefix, giving prefix_col.

    Groups without any known value are left out.
    """
    fractions = sorted(names)
    _, ranked = with_percentiles(df, cols, fractions, by, definition)
    return ranked.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("variable") == c, _value(i))).alias(f"{names[p]}_{c}")
            for c in cols
            for i, p in enumerate(fractions)
        ]
    )


def with_percentiles(
    df: DataFrame,
    cols,
    fractions,
    by=(),
    definition: str = "linear",
    accuracy: int = 10_000,
    total: bool = False,
    aggregates=(),
) -> tuple[DataFrame, DataFrame]:
    """Group table with further `aggregates`, and by..., variable, __values, from the same passes.

    __values holds the percentiles by rising fraction; a group without known values of a variable has no row there.
    With `total` both also hold the group of all rows, flagged by `is_total`.
    """
    if definition not in POSITION:
        raise ValueError(f"definition must be one of {tuple(POSITION)}, not {definition!r}")
    cols, by = ([cols] if isinstance(cols, str) else list(cols)), list(by)
    fractions = sorted(set(fractions))
    margin = 2.0 / accuracy
    cut_at = [c for p in fractions for c in (max(p - margin, 0.0), min(p + margin, 1.0))]
    rows = df.select(*by, *[finite(c).alias(c) for c in cols])

    sketches = [
        F.struct(F.count(c).alias("n"), F.percentile_approx(c, cut_at, accuracy).alias("cuts")).alias(
            f"__s{i}"
        )
        for i, c in enumerate(cols)
    ]
    if total:
        keys = [F.col(b) for b in by]
        flag = (F.grouping_id() > 0).alias("is_total")
        groups = freeze(rows.groupingSets([keys, []], *keys).agg(flag, *aggregates, *sketches))
    else:
        groups = freeze(rows.groupBy(*by).agg(*aggregates, *sketches))
    names = [f"__s{i}" for i in range(len(cols))]
    rows = rows.select(*by, *[F.col(c).alias(f"__x{i}") for i, c in enumerate(cols)])
    if total:
        own = groups.filter("NOT is_total").select(*by, *names)
        whole = groups.filter("is_total").select(*[F.col(n).alias(n.replace("s", "t")) for n in names])
        cut = attach(attach(rows, own, by), whole, ())
        kinds = dict(rows.dtypes)
        nulls = {b: F.lit(None).cast(kinds[b]).alias(b) for b in by}
        entries = _entries(cols, fractions, "s", [*[F.col(b) for b in by], F.lit(False).alias("is_total")])
        entries += _entries(cols, fractions, "t", [*nulls.values(), F.lit(True).alias("is_total")])
        by = [*by, "is_total"]
    else:
        cut = attach(rows, groups.select(*by, *names), by)
        entries = _entries(cols, fractions, "s", [F.col(b) for b in by])
    placed = cut.select(F.inline(F.array(*entries))).filter("__zone IS NOT NULL")
    key = [*by, "variable", "__zone"]
    counted = placed.groupBy(*key, F.when(F.col("__near"), F.col("__x")).alias("__x")).agg(
        F.count(F.lit(1)).alias("__m"), F.min("__x").alias("__least"), F.max("__x").alias("__most")
    )
    held = F.when(F.col("__x").isNotNull(), F.struct(F.col("__x").alias("x"), F.col("__m").alias("m")))
    seen = freeze(
        counted.groupBy(*key).agg(
            F.sum("__m").alias("__m"),
            F.min("__least").alias("__least"),
            F.max("__most").alias("__most"),
            F.sort_array(F.collect_list(held)).alias("__held"),
        )
    )
    return groups.drop(*names), _ranked(seen, by, fractions, definition)


def _ranked(seen: DataFrame, by, fractions, definition: str) -> DataFrame:
    """by..., variable, __values from the pieces: their sizes, and the values that those inside a bracket hold."""
    group = [*by, "variable"]
    size = F.struct(F.col("__zone").alias("zone"), F.col("__m").alias("m"))
    # At most two zones per fraction and one more, each in at most PARTS pieces.
    zones = seen.groupBy(*group).agg(F.sum("__m").alias("n"), F.sort_array(F.collect_list(size)).alias("__zones"))
    wanted = _targets(zones, fractions, definition)
    spot = F.expr(
        """aggregate(__zones, named_struct('before', 0L, 'zone', CAST(NULL AS INT), 'place', 0L), (s, z) ->
             CASE WHEN s.zone IS NOT NULL THEN s
                  WHEN s.before + z.m < __rank THEN named_struct('before', s.before + z.m, 'zone', s.zone, 'place', 0L)
                  ELSE named_struct('before', s.before, 'zone', z.zone, 'place', __rank - s.before) END)"""
    )
    asked = wanted.withColumn("__spot", spot).select(
        *group, "__p", "__side", "__weight", F.col("__spot.zone").alias("__zone"), F.col("__spot.place").alias("__place")
    )
    kind = dict(seen.dtypes)["__least"]
    inside = F.expr(
        f"""aggregate(__held, named_struct('upto', 0L, 'x', CAST(NULL AS {kind})), (s, e) ->
              IF(s.upto >= __place, s, named_struct('upto', s.upto + e.m, 'x', e.x))).x"""
    )
    # A definition may ask for the rank next to a bracket: the first or the last one of the zone beside it.
    beside = F.when(F.col("__place") == 1, F.col("__least")).when(F.col("__place") == F.col("__m"), F.col("__most"))
    found = attach(asked, seen, [*group, "__zone"])
    found = found.withColumn("__at", F.when(F.size("__held") > 0, inside).otherwise(beside))

    def of(p, side):
        return F.max(F.when((F.col("__p") == p) & (F.col("__side") == side), F.col("__at"))).cast("double")

    places = range(len(fractions))
    pairs = found.groupBy(*group).agg(
        *[of(p, side).alias(f"__{name}{p}") for p in places for side, name in enumerate(("low", "high"))],
        *[F.max(F.when(F.col("__p") == p, F.col("__weight"))).alias(f"__weight{p}") for p in places],
        F.max(F.col("__at").isNull()).alias("__missed"),
    )
    values = [F.col(f"__low{p}") + F.col(f"__weight{p}") * (F.col(f"__high{p}") - F.col(f"__low{p}")) for p in places]
    failed = F.raise_error(F.lit("a percentile lies outside its bracket; the input changed between two reads"))
    return pairs.select(*group, F.when(F.col("__missed"), failed).otherwise(F.array(*values)).alias("__values"))


def _entries(cols, fractions, sketch, keys) -> list:
    """For each column its value's place: the zone between cuts, in pieces, and whether in a bracket.

    The cuts rise with the fraction, at either end of the brackets: a value has entered the first brackets and left
    the first of those. The two numbers are found once for each value and all else follows from them; written out
    for every bracket, the code grows too long for Java to compile.
    """

    def entry(i, name):
        x, cuts = f"__x{i}", f"__{sketch}{i}.cuts"
        at_least = [f"int({x} >= {cuts}[{2 * k}])" for k in range(len(fractions))]
        above = [f"int({x} > {cuts}[{2 * k + 1}])" for k in range(len(fractions))]
        numbers = F.struct(F.expr(" + ".join(at_least)).alias("entered"), F.expr(" + ".join(above)).alias("left"))

        def placed(v):
            near = v.getField("entered") > v.getField("left")
            # Which brackets hold a value is the same all over a zone, so the pieces of the first keep the order.
            low, high = (F.get(F.col(cuts), 2 * v.getField("left") + end).cast("double") for end in (0, 1))
            share = F.try_divide(F.col(x).cast("double") - low, high - low)
            piece = F.coalesce(F.least((share * PARTS).try_cast("int"), F.lit(PARTS - 1)), F.lit(0))
            zone = (v.getField("entered") + v.getField("left")) * PARTS + F.when(near, piece).otherwise(0)
            return F.struct(
                *keys, F.lit(name).alias("variable"), F.col(x).alias("__x"), zone.alias("__zone"), near.alias("__near")
            )

        return F.transform(F.array(numbers), placed).getItem(0)

    return [entry(i, c) for i, c in enumerate(cols)]


def _targets(zones: DataFrame, fractions, definition) -> DataFrame:
    """The lower and upper rank of every fraction, for rows with the number n of values: __p, __side, __rank, __weight."""
    exact = [int((Decimal(repr(float(p))) * SCALE).to_integral_value()) for p in fractions]
    wanted = ", ".join(f"struct({i} AS __p, CAST({p} AS DECIMAL(18, 0)) AS p)" for i, p in enumerate(exact))
    table = zones.withColumn("n", F.col("n").cast("decimal(19, 0)"))
    table = table.selectExpr("*", f"inline(array({wanted}))")
    table = table.selectExpr("*", f"CAST({POSITION[definition]} AS DECIMAL(38, 0)) AS position")
    table = table.selectExpr("*", f"position div {SCALE} AS whole", f"position % {SCALE} AS part")
    table = table.withColumn("n", F.col("n").cast("long"))
    if definition == "averaged":
        low, high, weight = "if(part = 0, whole, whole + 1)", "whole + 1", "0.5D"
    else:
        low, high, weight = "whole", "whole + 1", f"double(part) / {float(SCALE)!r}D"
    table = table.selectExpr(
        "*", f"{weight} AS __weight", f"inline(array(struct(0 AS __side, {low} AS r), struct(1 AS __side, {high} AS r)))"
    )
    return table.withColumn("__rank", F.expr("least(greatest(r, 1L), n)"))
