"""Greedy matching of predicted boxes to ground truth, and per-frame failure accounting.

Predictions of a (frame, class), most confident first, each claim the unclaimed
ground-truth box they overlap most, if the overlap reaches the threshold. Ties are fixed:
equal confidence goes to the smaller prediction id, equal overlap to the smaller box id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from wayframe.functions.geometry import IMAGE_WIDTH, iou, visibility_at_least
from wayframe.functions.taxonomy import class_index
from wayframe.sources.scratch import settle

CORNERS = ("x_min", "y_min", "x_max", "y_max")
MATCH_COLUMNS = ("frame", "cls", "iou_threshold", "pred_id", "gt_id", "conf", "iou")
CLAIM_COLUMNS = ("frame", "cls", "pred_id", "gt_id", "conf", "iou", "reached")
# Above this many prediction-truth pairs a (frame, class) is matched by rounds of joins
# instead of in one row.
FOLD_LIMIT = 250_000
GRID = 64  # cells across the image of the most crowded groups


def ground_truth(
    annotations: DataFrame, *, visibility_min: int | None = None
) -> DataFrame:
    """Annotations of detector classes as ``frame, box_id, cls, x_min..y_max``."""
    boxes = annotations.filter(F.col("category_group").isNotNull())
    if visibility_min is not None:
        boxes = boxes.filter(visibility_at_least(F.col("visibility_token"), visibility_min))
    return boxes.select(
        F.col("sample_data_token").alias("frame"),
        F.col("annotation_token").alias("box_id"),
        class_index(F.col("category_group")).alias("cls"),
        *CORNERS,
    )


def _boxes(df: DataFrame, name: str, *extra: str) -> DataFrame:
    return df.select("frame", "cls", F.struct("box_id", *extra, *CORNERS).alias(name))


def overlapping_pairs(pred: DataFrame, gt: DataFrame, iou_min: float = 0.5) -> DataFrame:
    """Prediction-truth pairs of the same frame and class with IoU at least ``iou_min``."""
    return (
        _boxes(pred, "p", "conf")
        .join(_boxes(gt, "g"), ["frame", "cls"])
        .withColumn("iou", iou("p", "g"))
        .filter(F.col("iou") >= iou_min)
        .select(
            "frame", "cls", F.col("p.box_id").alias("pred_id"), F.col("p.conf").alias("conf"),
            F.col("g.box_id").alias("gt_id"), "iou",
        )
    )


def _gridded_pairs(pred: DataFrame, gt: DataFrame, iou_min: float) -> DataFrame:
    """The same pairs for crowded frames, compared only within cells of a grid.

    Rows carry ``_grid``, how many cells their group's grid has across the image: a box of a
    small group is in one cell, or a few at its border. Each box is listed in every cell it touches; a pair is kept in the one cell that holds
    the corner where its overlap starts, so nothing is found twice.
    """
    cell = F.lit(float(IMAGE_WIDTH)) / F.col("_grid")

    def cells(df: DataFrame) -> DataFrame:
        for axis in ("x", "y"):
            first = F.floor(F.col(f"{axis}_min") / cell)
            last = F.floor(F.col(f"{axis}_max") / cell)
            df = df.withColumn(f"cell_{axis}", F.explode(F.sequence(first, last)))
        return df

    keys = ["frame", "cls", "_grid", "cell_x", "cell_y"]
    p = cells(pred).select(*keys, F.struct("box_id", "conf", *CORNERS).alias("p"))
    g = cells(gt).select(*keys, F.struct("box_id", *CORNERS).alias("g"))
    start = [F.floor(F.greatest(f"p.{a}_min", f"g.{a}_min") / cell) for a in ("x", "y")]
    return (
        p.join(g, keys)
        .filter((start[0] == F.col("cell_x")) & (start[1] == F.col("cell_y")))
        .withColumn("iou", iou("p", "g"))
        .filter(F.col("iou") >= iou_min)
        .select(
            "frame", "cls", F.col("p.box_id").alias("pred_id"), F.col("p.conf").alias("conf"),
            F.col("g.box_id").alias("gt_id"), "iou",
        )
    )


def _reach(thresholds: Sequence[float]) -> Column:
    """A bit for each threshold that a pair's IoU reaches."""
    bits = [F.when(F.col("iou") >= F.lit(float(t)), F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(thresholds)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits).cast("long")


def _per_threshold(matches: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """One row per match and threshold from rows with ``reached`` bits."""
    ladder = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(1 << k).cast("long").alias("bit")) for k, t in enumerate(thresholds)])
    held = F.transform(F.filter(ladder, lambda x: x["bit"].bitwiseAND(F.col("reached")) != 0), lambda x: x["t"])
    return matches.withColumn("iou_threshold", F.explode(held)).select(*MATCH_COLUMNS)


def _claim_in_order(pairs: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Resolve each small group in one row: one fold over its pairs in claiming order.

    The thresholds are bits of a number that every claim carries: a pair claims at those
    that it reaches and at which neither of its boxes is taken yet. So pairs are shuffled
    and folded once, however many thresholds there are.
    """
    entry = F.struct(
        (-F.col("conf")).alias("rank"), "pred_id", (-F.col("iou")).alias("far"), "gt_id", _reach(thresholds).alias("open")
    )
    groups = pairs.groupBy("frame", "cls").agg(F.array_sort(F.collect_list(entry)).alias("pairs"))
    fields = {f.name: f.dataType.simpleString() for f in pairs.schema}
    match = f"struct<pred_id:{fields['pred_id']},gt_id:{fields['gt_id']},conf:double,iou:double,reached:bigint>"

    def made(pair: Column, reached: Column) -> Column:
        return F.struct(
            pair["pred_id"].alias("pred_id"), pair["gt_id"].alias("gt_id"),
            (-pair["rank"]).alias("conf"), (-pair["far"]).alias("iou"), reached.alias("reached"),
        )

    def claim(done, pair):
        own = F.filter(done, lambda m: (m["pred_id"] == pair["pred_id"]) | (m["gt_id"] == pair["gt_id"]))
        taken = F.aggregate(own, F.lit(0).cast("long"), lambda bits, m: bits.bitwiseOR(m["reached"]))
        free = pair["open"].bitwiseAND(F.bitwise_not(taken))
        return F.when(free == 0, done).otherwise(F.array_append(done, made(pair, free)))

    # Most groups hold a single pair, which needs no fold.
    only = F.col("pairs")[0]
    single = F.array(made(only, only["open"])).cast(f"array<{match}>")
    folded = F.aggregate("pairs", F.array().cast(f"array<{match}>"), claim)
    claims = F.when(F.size("pairs") == 1, single).otherwise(folded)
    return groups.select("frame", "cls", F.inline(claims)).select(*CLAIM_COLUMNS)


def _claim_by_rounds(pairs: DataFrame) -> DataFrame:
    """Resolve crowded groups with joins: the same claims, found in parallel rounds.

    In a round a prediction claims its best free box when no other unresolved prediction
    that overlaps that box comes before it; such claims cannot change later. Claimed
    predictions and boxes leave, and rounds repeat until no pair is left. The most
    confident prediction of every group always succeeds, so the loop ends.
    """
    group = ["frame", "cls", "iou_threshold"]
    columns = list(MATCH_COLUMNS)
    open_pairs = settle(pairs.select(*columns), "open-pairs")
    done = open_pairs.limit(0)
    while not open_pairs.isEmpty():
        # Aggregates rather than windows: a box or prediction with very many pairs is
        # reduced before the shuffle.
        wish = F.min(F.struct((-F.col("iou")).alias("far"), "gt_id", "conf", "iou"))
        choices = open_pairs.groupBy(*group, "pred_id").agg(wish.alias("w"))
        choices = choices.select(*group, "pred_id", "w.gt_id", "w.conf", "w.iou")
        turn = F.min(F.struct((-F.col("conf")).alias("rank"), "pred_id"))
        turns = open_pairs.groupBy(*group, "gt_id").agg(turn.alias("t"))
        turns = turns.select(*group, "gt_id", F.col("t.pred_id").alias("pred_id"))
        claims = settle(
            choices.join(turns, [*group, "pred_id", "gt_id"]).select(*columns), "claims"
        )
        done = done.unionByName(claims)
        open_pairs = settle(
            open_pairs.join(claims.select(*group, "pred_id"), [*group, "pred_id"], "left_anti")
            .join(claims.select(*group, "gt_id"), [*group, "gt_id"], "left_anti")
            .select(*columns),
            "open-pairs",
        )
    return done


def match_claims(
    pred: DataFrame,
    gt: DataFrame,
    thresholds: Sequence[float] = (0.5,),
    *,
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """Greedy matches per (frame, class), as ``CLAIM_COLUMNS``: the thresholds a pair matches at are bits.

    Both inputs are read twice, so they should be stored tables (see ``settle``). Group
    sizes are counted first. Ordinary groups are folded in one row each; groups
    with more than ``fold_limit`` possible pairs are compared on a grid and resolved by
    rounds of joins, with the same result.
    """
    lowest = min(thresholds)
    if lowest <= 0:
        raise ValueError("an IoU threshold must be positive: boxes apart do not match")
    sizes = [
        side.groupBy("frame", "cls").agg(F.count("*").alias(name))
        for side, name in ((pred, "_n_pred"), (gt, "_n_gt"))
    ]
    crowded = settle(
        sizes[0].join(sizes[1], ["frame", "cls"])
        .filter(F.col("_n_pred") * F.col("_n_gt") > fold_limit)
        # As many cells as there are boxes on a side, about.
        .select("frame", "cls", F.least(F.lit(GRID), F.pow(F.col("_n_pred") * F.col("_n_gt"), F.lit(0.25))).cast("int").alias("_grid")),
        "crowded",
    )
    if crowded.isEmpty():
        return _claim_in_order(overlapping_pairs(pred, gt, lowest), thresholds)

    def part(df: DataFrame, how: str) -> DataFrame:
        return df.join(crowded, ["frame", "cls"], how)

    ordinary = overlapping_pairs(part(pred, "left_anti"), part(gt, "left_anti"), lowest)
    dense = _gridded_pairs(part(pred, "inner"), part(gt, "inner"), lowest)
    rounds = _claim_by_rounds(_per_threshold(dense.withColumn("reached", _reach(thresholds)), thresholds))
    bit = reduce(lambda x, kt: x.when(F.col("iou_threshold") == kt[1], 1 << kt[0]), enumerate(map(float, thresholds)), F).cast("long")
    rounds = rounds.groupBy("frame", "cls", "pred_id", "gt_id", "conf", "iou").agg(F.sum(bit).alias("reached"))
    return _claim_in_order(ordinary, thresholds).unionByName(rounds.select(*CLAIM_COLUMNS))


def match_boxes(
    pred: DataFrame,
    gt: DataFrame,
    thresholds: Sequence[float] = (0.5,),
    *,
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """The matches of :func:`match_claims` with a row per threshold, as ``MATCH_COLUMNS``."""
    return _per_threshold(match_claims(pred, gt, thresholds, fold_limit=fold_limit), thresholds)


def score_frames(
    frames: DataFrame, gt: DataFrame, matches: DataFrame, *, conf_hit: float = 0.4
) -> DataFrame:
    """Failures per frame: unclaimed boxes plus half of each low-confidence hit.

    ``frames`` has ``sample_data_token`` and any context columns; frames without ground
    truth or predictions score zero.
    """
    truth = gt.groupBy("frame").agg(F.count("*").alias("n_gt"))
    hits = matches.groupBy("frame").agg(
        F.count("*").alias("n_matched"),
        F.count_if(F.col("conf") < conf_hit).alias("n_low_conf"),
    )
    counts = truth.join(hits, "frame", "left").withColumnRenamed("frame", "sample_data_token")
    zero = F.lit(0).cast("long")
    joined = frames.join(counts, "sample_data_token", "left")
    n = {c: F.coalesce(F.col(c), zero) for c in ("n_gt", "n_matched", "n_low_conf")}
    missed = n["n_gt"] - n["n_matched"]
    return joined.select(
        *frames.columns,
        n["n_gt"].alias("n_gt"),
        n["n_matched"].alias("n_matched"),
        missed.alias("n_fn"),
        n["n_low_conf"].alias("n_low_conf"),
        (missed + n["n_low_conf"] * 0.5e0).alias("failure_score"),
    )


def failure_sweep(
    samples: DataFrame,
    annotations: DataFrame,
    predictions: DataFrame,
    val_scenes: DataFrame,
    *,
    channel: str = "CAM_FRONT",
    visibility_min: int | None = 2,
    iou_min: float = 0.5,
    conf_low: float = 0.05,
    conf_hit: float = 0.4,
    limit: int | None = None,
) -> DataFrame:
    """Failure table of one camera's validation frames from a predictions table."""
    frames = (
        samples.filter(F.col("channel") == channel)
        .join(val_scenes.select("scene_name"), "scene_name", "left_semi")
        .select("sample_data_token", "scene_name", "is_night")
    )
    if limit is not None:
        frames = frames.orderBy("sample_data_token").limit(limit)
    token = frames.select(F.col("sample_data_token").alias("frame"))
    truth = ground_truth(annotations, visibility_min=visibility_min)
    # Both sides are read several times: for group sizes, matching and totals.
    truth = settle(truth.join(token, "frame", "left_semi"), "truth")
    found = predictions.filter(F.col("conf") >= conf_low)
    found = settle(found.join(token, "frame", "left_semi"), "predictions")
    return score_frames(frames, truth, match_boxes(found, truth, (iou_min,)), conf_hit=conf_hit)


def summarize_failures(failures: DataFrame) -> DataFrame:
    """One row of sweep totals; means of an empty side are 0."""

    def mean(condition=None):
        score = F.col("failure_score")
        value = score if condition is None else F.when(condition, score)
        return F.coalesce(F.avg(value), F.lit(0.0))

    return failures.agg(
        F.count("*").alias("n_frames"),
        mean().alias("mean_failure_score"),
        mean(~F.col("is_night")).alias("mean_failure_score_day"),
        mean(F.col("is_night")).alias("mean_failure_score_night"),
        F.coalesce(F.sum("n_fn"), F.lit(0)).alias("total_fn"),
        F.coalesce(F.sum("n_low_conf"), F.lit(0)).alias("total_low_conf"),
    )


def top_failures(failures: DataFrame, k: int = 1000) -> DataFrame:
    """The k worst frames, ties by token."""
    return failures.orderBy(F.desc("failure_score"), "sample_data_token").limit(k)
