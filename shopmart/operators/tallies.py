"""Children of an order counted by keys: a few rows per order instead of one per child.

`Tally` says what is counted. On the flat parts it is an aggregate by order. In
the nested table it is a histogram computed inside the row: the children are
sorted by their keys, the places where the keys change are found, and every
stretch becomes one struct with its count and sums. That takes n log n steps
for n children and neither explodes nor shuffles them, so several children of
an order meet in the row they are stored in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


# Name of the number of children where a tally does not ask for it.
NUMBER = "tally_number"


@dataclass(frozen=True)
class Tally:
    """Children `part` by `keys`: `n` names their number, `sums` and `known` (non-null values) map names to columns.

    With `optional` an order without such children stays, with nulls.
    """

    part: str
    keys: Sequence[str] = ()
    n: str | None = None
    sums: Mapping[str, str] = field(default_factory=dict)
    known: Mapping[str, str] = field(default_factory=dict)
    optional: bool = False

    def measures(self) -> list[Column]:
        """The figures as aggregates over rows of children."""
        number = [F.count("*").alias(self.n)] if self.n else []
        sums = [F.sum(c).alias(name) for name, c in self.sums.items()]
        return [*number, *sums, *[F.count(c).alias(name) for name, c in self.known.items()]]


def _sum_type(table: DataFrame, array: str, column: str) -> str:
    """The type Spark gives a sum of the column."""
    kind = table.schema[array].dataType.elementType[column].dataType
    return f"decimal({min(38, kind.precision + 10)},{kind.scale})" if isinstance(kind, DecimalType) else "bigint"


def _sum(places: Column, value_at: Callable[[Column], Column], kind: str) -> Column:
    """A sum over places that passes over nulls and is null without values."""

    def add(acc: Column, place: Column) -> Column:
        value = value_at(place)
        return F.when(acc.isNull(), value.cast(kind)).when(value.isNull(), acc).otherwise((acc + value).cast(kind))

    return F.aggregate(places, F.lit(None).cast(kind), add)


def _figures(table: DataFrame, array: str, tally: Tally, places: Column, number: Column) -> list[Column]:
    """The figures of the children at some places of an array, counted from 1.

    Single elements are looked up, since a slice copies its whole array.
    """

    def value_of(column: str) -> Callable[[Column], Column]:
        return lambda place: F.element_at(array, place)[column]

    def is_known(column: str) -> Callable[[Column], Column]:
        return lambda place: value_of(column)(place).isNotNull()

    n = number.cast("long").alias(tally.n or NUMBER)
    sums = [_sum(places, value_of(c), _sum_type(table, array, c)).alias(name) for name, c in tally.sums.items()]
    known = [F.size(F.filter(places, is_known(c))).cast("long").alias(name) for name, c in tally.known.items()]
    return [n, *sums, *known]


def with_tally(table: DataFrame, array: str, tally: Tally, name: str) -> DataFrame:
    """Adds `name`, an array with one struct of keys and figures for every distinct keys in `array`.

    Each step is a column of its own, because an expression inside a lambda
    would be evaluated once per element.
    """
    if not tally.keys:
        size = F.size(array)
        whole = F.array(F.struct(*_figures(table, array, tally, F.sequence(F.lit(1), size), size)))
        return table.withColumn(name, F.when(size > 0, whole))
    carried = list(dict.fromkeys([*tally.sums.values(), *tally.known.values()]))

    def ordered(x: Column) -> Column:
        key = F.struct(*[x[k].alias(k) for k in tally.keys]).alias("key")
        return F.struct(key, *[x[c].alias(c) for c in carried])

    rows, starts = f"{name}_rows", f"{name}_starts"
    table = table.withColumn(rows, F.sort_array(F.transform(array, ordered)))
    size = F.size(rows)

    def first_of_key(p: Column) -> Column:
        before = F.element_at(rows, F.greatest(p - 1, F.lit(1)))
        return (p == 1) | ~F.element_at(rows, p)["key"].eqNullSafe(before["key"])

    table = table.withColumn(starts, F.when(size > 0, F.filter(F.sequence(F.lit(1), size), first_of_key)))
    stretches = F.transform(
        starts, lambda p, j: F.struct(p.alias("at"), (F.coalesce(F.get(starts, j + 1), size + 1) - p).alias("n"))
    )

    def group(s: Column) -> Column:
        key = F.element_at(rows, s["at"])["key"]
        figures = _figures(table, rows, tally, F.sequence(s["at"], s["at"] + s["n"] - 1), s["n"])
        return F.struct(*[key[k].alias(k) for k in tally.keys], *figures)

    return table.withColumn(name, F.transform(stretches, group)).drop(rows, starts)


def unfolded(table: DataFrame, tally: Tally, name: str) -> DataFrame:
    """One row per struct of `name`, its fields as columns.

    The outer form, with empty rows dropped behind it: for the plain one Spark
    infers a filter on the size of the array, and would compute all steps of the
    array anew for it, inside one another.
    """
    found = table.select(*[c for c in table.columns if c != name], F.inline_outer(name))
    number = tally.n or NUMBER
    found = found if tally.optional else found.where(F.col(number).isNotNull())
    return found if tally.n else found.drop(number)
