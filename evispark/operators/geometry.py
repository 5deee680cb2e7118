"""Spatial operators within slides: overlap conflicts, crops between neighbours, best detector matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evispark.functions.columns import floor_div, iou, overlap

BOX = ("x", "y", "width", "height")


def side(df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    return df.select("slide_number", *(F.col(c).alias(f"{name}_{c}") for c in keep))


def overlaps(elements: DataFrame, share: float = 0.75, left: tuple[str, ...] = ("native",), right: tuple[str, ...] = ("ocr", "vlm")) -> DataFrame:
    """(slide_number, a_id, b_id, a_text, b_text): native boxes and ones that were read, of which the smaller is covered to `share` at least.

    The slide is the join's key, so only boxes of one slide meet."""
    keep = ["element_id", *BOX, "text"]
    a = side(elements.where(F.col("source").isin(*left)), "a", keep)
    b = side(elements.where(F.col("source").isin(*right)), "b", keep)
    x = overlap(F.col("a_x"), F.col("a_x") + F.col("a_width"), F.col("b_x"), F.col("b_x") + F.col("b_width"))
    y = overlap(F.col("a_y"), F.col("a_y") + F.col("a_height"), F.col("b_y"), F.col("b_y") + F.col("b_height"))
    small = F.least(F.col("a_width") * F.col("a_height"), F.col("b_width") * F.col("b_height"))
    return a.join(b, "slide_number").where((small > 0) & (x * y > 0) & (x * y >= small * share)).select("slide_number", "a_element_id", "b_element_id", "a_text", "b_text")


def numeric_conflicts(pairs: DataFrame, numbers) -> DataFrame:
    """Overlapping pairs whose sets of raw numbers are both there and differ. numbers: Column -> array Column."""
    with_sets = pairs.withColumn("a_numbers", F.array_sort(F.array_distinct(numbers(F.col("a_text"))))).withColumn("b_numbers", F.array_sort(F.array_distinct(numbers(F.col("b_text")))))
    return with_sets.where((F.size("a_numbers") > 0) & (F.size("b_numbers") > 0) & (F.col("a_numbers") != F.col("b_numbers")))


def raw_numbers(text: Column) -> Column:
    from evispark.functions.patterns import RAW_NUMBER

    return F.regexp_extract_all(text, F.lit(f"({RAW_NUMBER})"), 1)


def midgap_crops(elements: DataFrame, slide_width: int, slide_height: int, ratio: float = 0.1) -> DataFrame:
    """(slide_number, element_id, left, top, right, bottom): each box padded, but not beyond the middle of the gap to a
    neighbour that lies beside it; never smaller than the box. Largest and smallest bounds are aggregates, so the order of
    neighbours doesn't matter."""
    keep = ["element_id", *BOX]
    a, b = side(elements, "a", keep), side(elements.where((F.col("width") > 0) & (F.col("height") > 0)), "b", keep)
    x1, y1, x2, y2 = F.col("a_x"), F.col("a_y"), F.col("a_x") + F.col("a_width"), F.col("a_y") + F.col("a_height")
    u1, v1, u2, v2 = F.col("b_x"), F.col("b_y"), F.col("b_x") + F.col("b_width"), F.col("b_y") + F.col("b_height")
    beside, stacked = overlap(y1, y2, v1, v2) > 0, overlap(x1, x2, u1, u2) > 0
    two = F.lit(2)
    low = lambda p, q: floor_div(p + q, two)
    high = lambda p, q: -floor_div(-(p + q), two)
    other = F.col("a_element_id") != F.col("b_element_id")
    bounds = a.join(b, "slide_number").groupBy("slide_number", "a_element_id", "a_x", "a_y", "a_width", "a_height").agg(
        F.max(F.when(other & beside & (u2 <= x1), high(u2, x1))).alias("l"),
        F.min(F.when(other & beside & (u1 >= x2), low(x2, u1))).alias("r"),
        F.max(F.when(other & stacked & (v2 <= y1), high(v2, y1))).alias("t"),
        F.min(F.when(other & stacked & (v1 >= y2), low(y2, v1))).alias("b"),
    )
    px, py = round(slide_width * ratio), round(slide_height * ratio)
    return bounds.select(
        "slide_number",
        F.col("a_element_id").alias("element_id"),
        F.least(x1, F.greatest(x1 - px, F.lit(0), F.coalesce("l", F.lit(0)))).alias("left"),
        F.least(y1, F.greatest(y1 - py, F.lit(0), F.coalesce("t", F.lit(0)))).alias("top"),
        F.greatest(x2, F.least(x2 + px, F.lit(slide_width), F.coalesce("r", F.lit(slide_width)))).alias("right"),
        F.greatest(y2, F.least(y2 + py, F.lit(slide_height), F.coalesce("b", F.lit(slide_height)))).alias("bottom"),
    )


def model_images(crops: DataFrame, padding: int = 24) -> DataFrame:
    """crops with the size of the image that a model gets, the crop on white with `padding` pixels around, and the place in the
    slide of that image's corner; a box that the model reads lies there plus this corner."""
    if padding < 0:
        raise ValueError("the padding can't be negative")
    wide, high = F.col("right") - F.col("left"), F.col("bottom") - F.col("top")
    return crops.withColumns({"model_width": wide + 2 * padding, "model_height": high + 2 * padding, "model_left": F.col("left") - padding, "model_top": F.col("top") - padding})


def outside_slide(elements: DataFrame, width: int, height: int) -> DataFrame:
    return elements.where((F.col("x") < 0) | (F.col("y") < 0) | (F.col("x") + F.col("width") > width) | (F.col("y") + F.col("height") > height))


def best_matches(blocks: DataFrame, boxes: DataFrame, least: float = 0.5, bonus: float = 0.05) -> DataFrame:
    """(image, block_id, box_id, quality): the detector box that fits a block best; equal labels add a bonus, ties go to
    the smaller box id. blocks: (image, block_id, label, box), boxes: (image, box_id, label, box) with [x1, y1, x2, y2]."""
    a, b = blocks.select("image", "block_id", F.lower("label").alias("la"), F.col("box").alias("ba")), boxes.select("image", "box_id", F.lower("label").alias("lb"), F.col("box").alias("bb"))
    corner = lambda c: [F.col(c)[i] for i in range(4)]
    quality = iou(corner("ba"), corner("bb")) + F.when(F.col("la") == F.col("lb"), bonus).otherwise(0.0)
    best = a.join(b, "image").withColumn("quality", quality).groupBy("image", "block_id").agg(F.max(F.struct("quality", (-F.col("box_id")).alias("minus"))).alias("m"))
    return best.where(F.col("m.quality") >= least).select("image", "block_id", (-F.col("m.minus")).alias("box_id"), F.col("m.quality").alias("quality"))
