"""Rule suites: every rule of a table is one conditional count of a single pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.functions.geometry import IMAGE_HEIGHT, IMAGE_WIDTH
from wayframe.functions.taxonomy import CAMERAS, CATEGORIES, DETECTION_CLASSES

# --- Fixed values -------------------------------------------------------------------
ANNOTATION_COLUMNS = (
    "annotation_token", "sample_data_token", "channel", "category_name", "category_group",
    "visibility_token", "x_min", "y_min", "x_max", "y_max", "bbox_area",
)
ANNOTATION_REQUIRED = (
    "annotation_token", "sample_data_token", "category_name", "x_min", "y_min", "x_max", "y_max",
)
SAMPLE_COLUMNS = (
    "sample_data_token", "sample_token", "channel", "filename", "width", "height", "n_boxes",
    "scene_token",
)
SAMPLE_REQUIRED = ("sample_data_token", "sample_token", "channel", "filename", "scene_token")
VISIBILITY_TOKENS = ("1", "2", "3", "4")
# 15 to 60 keyframes of six cameras.
IMAGES_PER_SCENE = (90, 360)
# --- End of fixed values ------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A named test of columns; ``broken`` is true (not NULL) for a violating row."""

    name: str
    columns: tuple[str, ...]
    broken: Column | None = None


def column_exists(*columns: str) -> list[Rule]:
    return [Rule("column_exists", (c,)) for c in columns]


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", (c,), F.col(c).isNull()) for c in columns]


def between(column: str, low: float, high: float) -> Rule:
    return Rule("between", (column,), ~F.col(column).between(low, high))


def positive(column: str) -> Rule:
    return Rule("positive", (column,), F.col(column) <= 0)


def at_least(column: str, low: float) -> Rule:
    return Rule("at_least", (column,), F.col(column) < low)


def equals(column: str, value) -> Rule:
    return Rule("equals", (column,), F.col(column) != value)


def greater(a: str, b: str) -> Rule:
    return Rule("greater", (a, b), F.col(a) <= F.col(b))


def in_set(column: str, values) -> Rule:
    return Rule("in_set", (column,), ~F.col(column).isin(*values))


def annotation_rules() -> list[Rule]:
    return [
        *column_exists(*ANNOTATION_COLUMNS),
        *not_null(*ANNOTATION_REQUIRED),
        *[between(c, 0, IMAGE_WIDTH) for c in ("x_min", "x_max")],
        *[between(c, 0, IMAGE_HEIGHT) for c in ("y_min", "y_max")],
        positive("bbox_area"),
        greater("x_max", "x_min"),
        greater("y_max", "y_min"),
        in_set("category_name", CATEGORIES),
        in_set("category_group", DETECTION_CLASSES),
        in_set("visibility_token", VISIBILITY_TOKENS),
    ]


def sample_rules() -> list[Rule]:
    return [
        *column_exists(*SAMPLE_COLUMNS),
        *not_null(*SAMPLE_REQUIRED),
        equals("width", IMAGE_WIDTH),
        equals("height", IMAGE_HEIGHT),
        in_set("channel", CAMERAS),
        at_least("n_boxes", 0),
    ]


def check(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """One row per rule: ``table, rule, column, violations, passed``.

    A test whose value is NULL is not a violation. A rule over a column the table does not
    have fails with NULL violations.
    """
    missing = [r for r in rules if not set(r.columns) <= set(df.columns)]
    tests = [(i, r) for i, r in enumerate(rules) if r not in missing]
    counts = {f"_{i}": F.count_if(r.broken) for i, r in tests if r.broken is not None}
    sums = df.agg(F.lit(1).alias("_one"), *[v.alias(k) for k, v in counts.items()])

    def row(rule: Rule, violations: Column) -> Column:
        return F.struct(
            F.lit(table).alias("table"),
            F.lit(rule.name).alias("rule"),
            F.lit(",".join(rule.columns)).alias("column"),
            violations.cast("long").alias("violations"),
            F.coalesce(violations == 0, F.lit(False)).alias("passed"),
        )

    rows = [row(r, F.col(f"_{i}") if f"_{i}" in counts else F.lit(0)) for i, r in tests]
    rows += [row(r, F.lit(None).cast("long")) for r in missing]
    return sums.select(F.inline(F.array(*rows)))


def check_unique(df: DataFrame, column: str, table: str) -> DataFrame:
    """Rows whose value occurs more than once; NULLs are skipped."""
    repeated = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    violations = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    return repeated.agg(violations.alias("violations")).select(
        F.lit(table).alias("table"), F.lit("unique").alias("rule"),
        F.lit(column).alias("column"), "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def scene_counts(
    samples: DataFrame, low: int = IMAGES_PER_SCENE[0], high: int = IMAGES_PER_SCENE[1]
) -> DataFrame:
    """Scenes whose image count is out of range."""
    counts = samples.groupBy("scene_token").agg(F.count("*").alias("n_images"))
    return counts.filter(~F.col("n_images").between(low, high))


def check_scene_counts(samples: DataFrame, low: int, high: int) -> DataFrame:
    return scene_counts(samples, low, high).agg(F.count("*").alias("violations")).select(
        F.lit("samples").alias("table"), F.lit("images_per_scene").alias("rule"),
        F.lit("scene_token").alias("column"), "violations",
        (F.col("violations") == 0).alias("passed"),
    )


def validate(
    samples: DataFrame, annotations: DataFrame, images_per_scene=IMAGES_PER_SCENE
) -> DataFrame:
    """Every rule of both tables."""
    return (
        check(annotations, annotation_rules(), "annotations")
        .unionByName(check(samples, sample_rules(), "samples"))
        .unionByName(check_unique(samples, "sample_data_token", "samples"))
        .unionByName(check_scene_counts(samples, *images_per_scene))
    )


def overall(results: DataFrame) -> DataFrame:
    """One row: did every rule pass."""
    return results.agg(
        F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("n_failed")
    )
