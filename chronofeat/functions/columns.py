"""Small column expressions shared by the plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this many seconds an age is shown in this unit of this many seconds.
AGE_UNITS = ((120, 1, "s"), (7200, 60, "min"), (172800, 3600, "h"), (None, 86400, "days"))


def event_id(*parts: Column | str) -> Column:
    """Parts joined by colons; null if any part is null."""
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    spaced = [t for text in texts for t in (F.lit(":"), text)][1:]
    return F.concat(*spaced)


def starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    """One `startswith` per prefix: unlike a regular expression these reach the Parquet scan."""
    return reduce(lambda a, b: a | b, [F.startswith(text, F.lit(p)) for p in prefixes])


def net_flow(arrivals: Column, departures: Column) -> Column:
    """Typical filling (positive) or draining (negative); null if either side is null."""
    return arrivals.cast("double") - departures.cast("double")


def as_number(value: Column) -> Column:
    """Double, or null where the value is not a number."""
    return value.try_cast("double")


def clean_numeric(value: Column) -> Column:
    """NaN becomes null."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def age_label(seconds: Column) -> Column:
    """An age in words, in the coarsest unit that suits it; "no data" for null."""
    label = F.when(seconds.isNull(), F.lit("no data"))
    for below, size, unit in AGE_UNITS:
        # Halves go to the even number, so an age on a tie reads the same everywhere.
        count = F.bround(seconds / size, 0).cast("long").cast("string")
        text = F.concat(count, F.lit(f" {unit} old"))
        label = label.when(seconds < below, text) if below else label.otherwise(text)
    return label
