"""Column helpers for text, dates, money and null-aware predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters other than the space after which a word starts.
WORD_BREAKS = r"\t\n\r\[\](){}/|\\<>!?@\"^#$&~_,.:;*%+\-"
# Fixed value: how review timestamps are written in the raw files.
REVIEW_FORMAT = "M/d/yyyy H:mm"

MONEY = "decimal(18,2)"
# Single amounts before they are summed; only sums are rounded. Products with counts stay exact, too.
EXACT = "decimal(24,6)"


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Spark's `initcap` starts words at spaces only, which is right for nearly
    all values; the split runs only where another break character occurs.
    """
    words = F.split(F.lower(text), f"(?<=[ {WORD_BREAKS}])")
    capital = F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2**31 - 1)))
    return F.when(text.rlike(f"[{WORD_BREAKS}]"), F.array_join(capital, "")).otherwise(F.initcap(text))


def label(text: Column) -> Column:
    """A snake_case code as a readable label."""
    return title_case(F.replace(text, F.lit("_"), F.lit(" ")))


def parse_review_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(REVIEW_FORMAT))


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "MMM yyyy")


def hour_boundaries(later_day: Column, earlier_ts: Column) -> Column:
    """Hour boundaries crossed from a timestamp to the midnight that starts a day.

    Counted on calendar fields, so the session time zone plays no part.
    """
    return F.datediff(later_day, earlier_ts.cast("date")).cast("long") * 24 - F.hour(earlier_ts)


def early_days(estimated: Column, delivered: Column) -> Column:
    """Days between delivery and the promised day, two decimals, late is negative."""
    return F.round(hour_boundaries(estimated, delivered) / F.lit(24.0), 2).cast(MONEY)


def on_time(delivered: Column, estimated: Column) -> Column:
    """1 if delivered by midnight at the start of the promised day, else 0 (also when undelivered)."""
    return F.when(delivered <= estimated.cast("timestamp_ntz"), 1).otherwise(0)


def money(value: Column) -> Column:
    """An exact decimal amount as the double the gold tables publish."""
    return F.round(value, 2).cast("double")


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """`part / whole` as double, null when `whole` is zero."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if digits is None else F.round(value, digits)


def count_where(condition: Column) -> Column:
    """How many rows satisfy the condition; 0, not null, when none does."""
    return F.count(F.when(condition, 1))


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """Rows of `df` whose key is NOT IN the keys of `other`, with SQL's null rules.

    One null in the list makes every comparison unknown, so nothing is
    returned; a null key is returned only when the list is empty. The list is
    made distinct first, so a key that fills it is combined before the shuffle.
    """
    keys = other.select(F.col(other_key or key).alias(key))
    return (
        df.where(~keys.where(F.col(key).isNull()).exists())
        .where(F.col(key).isNotNull() | ~keys.exists())
        .join(keys.where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    )
