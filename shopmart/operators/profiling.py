"""Table profiles: summary statistics, nulls, value shares."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.functions.columns import count_where, ratio

QUARTILES = (("q25", 0.25), ("median", 0.5), ("q75", 0.75))
# Rank error of an approximate percentile is at most rows / ACCURACY.
ACCURACY = 10_000
# Values among which a rank is looked up exactly; above it a narrowing pass over the table is cheaper.
EXACT_VALUES = 100_000
_GRID = [i / 200 for i in range(201)]


@dataclass(frozen=True)
class _Bracket:
    """Values of a column above `low` and under `high` (None: no limit): `inside` of them, and `below` up to `low`."""

    column: str
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0

    def value(self) -> Column:
        return F.col(self.column).cast("double")

    def within(self) -> Column:
        value, held = self.value(), F.lit(True)
        if self.low is not None:
            held &= value > self.low
        if self.high is not None:
            held &= value < self.high
        return F.when(held, value)

    def around(self, rank: int, grid: list[float]) -> tuple[float | None, float | None]:
        """Closer limits for a rank, by approximate percentiles with room for their error."""
        last = max(1, self.inside - 1)
        slack = 2 * self.inside / ACCURACY + 1
        low = math.floor((rank - self.below - slack) / last * (len(grid) - 1))
        high = math.ceil((rank - self.below + slack) / last * (len(grid) - 1))
        return grid[low] if low > 0 else self.low, grid[high] if high < len(grid) - 1 else self.high

    def counts(self) -> Column:
        """Values up to `low`, those equal to it, those inside, and those equal to `high`."""
        value = self.value()
        none = F.lit(0).cast("long")
        at_low = none if self.low is None else count_where(value == self.low)
        below = none if self.low is None else count_where(value < self.low)
        at_high = none if self.high is None else count_where(value == self.high)
        return F.struct(
            below.alias("below"), at_low.alias("at_low"), F.count(self.within()).alias("inside"), at_high.alias("at_high")
        )


def _aggregated(df: DataFrame, columns: Sequence[Column]) -> list:
    """Values of many aggregates from one pass."""
    return list(df.agg(*[c.alias(f"a{i}") for i, c in enumerate(columns)]).first()) if columns else []


Place = tuple[str, int]  # column and rank, from 0


def select_ranks(df: DataFrame, sizes: dict[Place, int]) -> dict[Place, float]:
    """Values at ranks of several columns; `sizes` holds the number of values of the column of each.

    Every round takes two passes and narrows all columns and ranks at once to
    brackets of about a hundredth of their values, with exact counts of what
    lies below, inside and on the edges; a last pass reads the ranks off the few
    values left. Values that fill an edge are settled by counting, so ties do
    not hold it up. No row is multiplied or shuffled, and only counts and
    bounds reach the driver.
    """
    found: dict[Place, float] = {}
    brackets = {place: _Bracket(place[0], inside=n) for place, n in sizes.items()}
    while large := {p: b for p, b in brackets.items() if b.inside > EXACT_VALUES}:
        distinct = list(dict.fromkeys(large.values()))
        grids = dict(zip(distinct, _aggregated(df, [F.percentile_approx(b.within(), _GRID, ACCURACY) for b in distinct])))
        closer = {p: replace(b, low=edges[0], high=edges[1]) for p, b in large.items() for edges in [b.around(p[1], grids[b])]}
        distinct = list(dict.fromkeys(closer.values()))
        counted = dict(zip(distinct, _aggregated(df, [b.counts() for b in distinct])))
        for place, bracket in closer.items():
            n = counted[bracket]
            over = place[1] - n["below"] - n["at_low"]  # rank among the values above the lower edge
            if not -n["at_low"] <= over < n["inside"] + n["at_high"]:
                raise ArithmeticError(f"{place} lies outside its bracket")  # by the proven error it cannot
            if over < 0 or over >= n["inside"]:
                found[place] = bracket.low if over < 0 else bracket.high
                del brackets[place]
            else:
                brackets[place] = replace(bracket, below=n["below"] + n["at_low"], inside=n["inside"])
    return {**found, **_read_off(df, brackets)}


def _read_off(df: DataFrame, brackets: dict[Place, _Bracket]) -> dict[Place, float]:
    """The values at the ranks, by one aggregate that holds no more than the values inside the brackets."""
    names = {b: f"v{i}" for i, b in enumerate(dict.fromkeys(brackets.values()))}
    inside = df.select(*[b.within().alias(name) for b, name in names.items()])
    # The middle of a rank, so that rounding cannot reach its neighbours.
    at = [
        F.expr(f"percentile_disc({(rank - b.below + 0.5) / b.inside!r}D) WITHIN GROUP (ORDER BY {names[b]})")
        for (_, rank), b in brackets.items()
    ]
    return dict(zip(brackets, _aggregated(inside, at)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles of every column.

    Quartiles between two values are interpolated linearly; a column without
    values has nulls.
    """
    spark = df.sparkSession
    values = [F.col(c).cast("double") for c in columns]
    figures = [
        F.struct(
            F.count(v).alias("count"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        )
        for v in values
    ]
    stats = dict(zip(columns, _aggregated(df, figures)))

    def ranks(row, share: float) -> tuple[int, int, float]:
        position = share * (row["count"] - 1)
        return math.floor(position), math.ceil(position), position - math.floor(position)

    filled = {c: row for c, row in stats.items() if row["count"]}
    sizes = {(c, r): row["count"] for c, row in filled.items() for _, q in QUARTILES for r in ranks(row, q)[:2]}
    found = select_ranks(df, sizes)
    out = []
    for column, row in stats.items():
        quartiles: list[float | None] = []
        for _, share in QUARTILES:
            low, high, part = ranks(row, share)
            ends = (found.get((column, low)), found.get((column, high)))
            quartiles.append(None if ends[0] is None else ends[0] + (ends[1] - ends[0]) * part)
        out.append((column, row["count"], row["mean"], row["std"], row["min"], *quartiles, row["max"]))
    kinds = "column string, count bigint, mean double, std double, min double, q25 double, median double, q75 double, max double"
    return spark.createDataFrame(out, kinds)


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and their share per column, in one pass."""
    nulls = [count_where(F.col(c).isNull()).alias(c) for c in df.columns]
    counted = df.agg(F.count("*").alias("__rows"), *nulls)
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), F.col("__rows").alias("rows")) for c in df.columns
    ]
    return counted.select(F.inline(F.array(*entries))).select(
        "column", "nulls", ratio(F.col("nulls"), F.col("rows")).alias("null_fraction")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share; the total is one row."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("share", ratio(F.col("rows"), total))


def share_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    above = count_where(F.col(column) > F.lit(threshold))
    return df.agg(ratio(above, F.count("*")).alias("share_above"))


def union_all(parts: dict[str, DataFrame], source: str) -> DataFrame:
    """All rows of several frames with the name of the frame they come from."""
    named = [df.withColumn(source, F.lit(name)) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)
