"""Scene-condition flags, slice rules and stratum labels."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# The default condition slices, by substrings of the scene description.
SLICES = {
    "time_of_day": {"day": {"exclude": ["night"]}, "night": {"include": ["night"]}},
    "weather": {"clear": {"exclude": ["rain"]}, "rain": {"include": ["rain"]}},
}

STRATUM_COLUMNS = ("location", "is_night", "is_rain")


def mentions(text: Column, word: str) -> Column:
    """Case-insensitive literal substring test ("tonight" does mention "night")."""
    return F.contains(F.lower(text), F.lit(word.lower()))


def with_flags(df: DataFrame, description: str = "scene_description") -> DataFrame:
    """Add ``is_night`` and ``is_rain`` read off the scene description."""
    return df.withColumns(
        {f"is_{word}": mentions(F.col(description), word) for word in ("night", "rain")}
    )


def matches_rule(text: Column, rule: Mapping[str, list[str]]) -> Column:
    """Every ``include`` word occurs and no ``exclude`` word does; an empty rule is true."""
    tests = [mentions(text, w) for w in rule.get("include", [])]
    tests += [~mentions(text, w) for w in rule.get("exclude", [])]
    return reduce(Column.__and__, tests, F.lit(True))


def slice_name(text: Column, slices: Mapping[str, Mapping[str, list[str]]]) -> Column:
    """First slice of one dimension whose rule matches, NULL when none does."""
    chain = F
    for name, rule in slices.items():
        chain = chain.when(matches_rule(text, rule), F.lit(name))
    return chain


def with_slices(df: DataFrame, config=SLICES, description: str = "scene_description") -> DataFrame:
    """Add one column per slice dimension with the first matching slice."""
    text = F.col(description)
    return df.withColumns({dim: slice_name(text, slices) for dim, slices in config.items()})


def slice_members(df: DataFrame, config=SLICES, description: str = "scene_description") -> DataFrame:
    """One row per (row, slice) it belongs to, tagged ``dim/slice``.

    Membership is by rule, so overlapping slices each get the row. The fan-out is the
    number of configured slices; no shuffle is involved.
    """
    text = F.col(description)
    tags = [
        F.when(matches_rule(text, rule), F.lit(f"{dim}/{name}"))
        for dim, slices in config.items()
        for name, rule in slices.items()
    ]
    return df.withColumn("slice", F.explode(F.array_compact(F.array(*tags))))


def stratum_label(location: Column, is_night: Column, is_rain: Column) -> Column:
    """``location|night-or-day|rain-or-dry``."""
    return F.concat_ws(
        "|",
        location,
        F.when(is_night, "night").otherwise("day"),
        F.when(is_rain, "rain").otherwise("dry"),
    )
