"""Page geometry on nested arrays: no rows are exploded, so nothing is shuffled."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazette_lake import fixed
from gazette_lake.functions.text import let, previous


def bounding_box(line: Column) -> Column:
    """struct(content, x0, y0, x1, y1) of a piece with a polygon."""
    xs = F.transform(line["polygon"], lambda p: p["x"])
    ys = F.transform(line["polygon"], lambda p: p["y"])
    return F.struct(
        line["content"].alias("content"),
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )


def body_box(page_idx: Column, width: Column, height: Column,
             first=fixed.FIRST_PAGE_BODY, later=fixed.LATER_PAGE_BODY) -> Column:
    """struct(left, top, right, bottom) of the page body in page units."""
    edge = lambda i: F.when(page_idx == 0, F.lit(first[i])).otherwise(F.lit(later[i]))
    return F.struct(
        (edge(0) * width).alias("left"), (edge(1) * height).alias("top"),
        (edge(2) * width).alias("right"), (edge(3) * height).alias("bottom"),
    )


def scale(box: Column, by_x: Column, by_y: Column) -> Column:
    return F.struct(
        box["content"].alias("content"),
        (box["x0"] * by_x).alias("x0"), (box["y0"] * by_y).alias("y0"),
        (box["x1"] * by_x).alias("x1"), (box["y1"] * by_y).alias("y1"),
    )


def inside(box: Column, body: Column) -> Column:
    """Whether a box lies fully in the body, borders included."""
    return F.coalesce(
        (body["left"] <= box["x0"]) & (box["x1"] <= body["right"])
        & (body["top"] <= box["y0"]) & (box["y1"] <= body["bottom"]),
        F.lit(False),
    )


def reading_order(boxes: Column) -> Column:
    """Boxes by top, then left; equal ones keep their order."""
    ranked = F.sort_array(F.transform(boxes, lambda box, i: F.struct(
        box["y0"].alias("y0"), box["x0"].alias("x0"), i.alias("i"), box.alias("box"))))
    return F.transform(ranked, lambda r: r["box"])


def most_frequent(values: Column) -> Column:
    """The most frequent value; of several, the one seen first.  Null for an empty array.

    One sort, then one pass over the runs of equal values.
    """
    ranked = F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    none = F.struct(
        F.lit(None).cast("double").alias("v"), F.lit(0).alias("n"), F.lit(0).alias("first"))

    def step(state: Column, item: Column) -> Column:
        grown = F.coalesce(state["run"]["v"] == item["v"], F.lit(False))
        run = F.struct(
            item["v"].alias("v"),
            F.when(grown, state["run"]["n"] + 1).otherwise(1).alias("n"),
            F.when(grown, state["run"]["first"]).otherwise(item["i"]).alias("first"),
        )

        def better(run: Column) -> Column:
            best = state["best"]
            wins = (run["n"] > best["n"]) | ((run["n"] == best["n"]) & (run["first"] < best["first"]))
            return F.struct(run.alias("run"), F.when(wins, run).otherwise(best).alias("best"))

        return let(run, better)

    start = F.struct(none.alias("run"), none.alias("best"))
    return F.aggregate(ranked, start, step, lambda state: state["best"]["v"])


def usual_line_height(boxes: Column) -> Column:
    """Most frequent height over all lines of a page, in the units of the boxes."""
    return most_frequent(F.transform(boxes, lambda b: b["y1"] - b["y0"]))


def share_height(before: Column, box: Column, line_height: Column) -> Column:
    """Whether a line continues the height of the line before it.  No line before, or one at 0: no."""
    drift = lambda side: F.try_divide(F.abs(before[side] - box[side]), box[side]) <= fixed.HEIGHT_DRIFT
    union = F.greatest(box["y1"], before["y1"]) - F.least(box["y0"], before["y0"])
    return F.coalesce(
        (before["y0"] != 0) & (before["y1"] != 0) & drift("y0") & drift("y1")
        & (union <= line_height * fixed.HEIGHT_SLACK),
        F.lit(False),
    )


def join_lines(lines: Column) -> Column:
    """Text of array<struct(content, same_line)>: a tab on one height, else one newline.

    No newline is put where the text is still empty, ends with one, or the line
    brings one.  Whether the text so far is "open" (empty or ending with a newline)
    depends on the line before only, so this is one pass without a growing string.
    """

    def piece(line: Column, before: Column) -> Column:
        open_text = before["content"].isNull() | ends_open(before)
        mark = (
            F.when(line["same_line"], F.lit("\t"))
            .when(open_text | line["content"].startswith("\n"), F.lit(""))
            .otherwise(F.lit("\n"))
        )
        return F.concat(mark, line["content"])

    return F.array_join(F.zip_with(lines, previous(lines), piece), "")


def ends_open(line: Column) -> Column:
    """Whether a text whose last line this is needs no newline before the next one.  A line without content does not count."""
    return (
        F.when(line["content"].isNull(), F.lit(True))
        .when(line["content"] == "", ~line["same_line"])
        .otherwise(line["content"].endswith("\n"))
    )


def line_part(lines: Column) -> Column:
    """Part of a text out of array<struct(content, same_line)>: its text, whether it brings its own newline, whether it
    ends open, and whether it has a line at all."""
    first, last = F.get(lines, F.lit(0)), F.get(lines, F.size(lines) - 1)
    return F.struct(
        F.coalesce(join_lines(lines), F.lit("")).alias("text"),
        F.coalesce(first["content"].startswith("\n"), F.lit(True)).alias("brings"),
        F.coalesce(ends_open(last), F.lit(True)).alias("open"),
        (F.size(lines) > 0).alias("some"))


def join_parts(parts: Column) -> Column:
    """Several parts as one.  Associative: parts may be joined in any groups, in their order."""

    def join(kept: Column) -> Column:
        marked = F.zip_with(kept, previous(kept), lambda part, before: F.concat(
            F.when(F.coalesce(before["open"], F.lit(True)) | part["brings"], F.lit("")).otherwise(F.lit("\n")), part["text"]))
        return F.struct(
            F.array_join(marked, "").alias("text"), F.coalesce(F.get(kept, F.lit(0))["brings"], F.lit(True)).alias("brings"),
            F.coalesce(F.get(kept, F.size(kept) - 1)["open"], F.lit(True)).alias("open"), (F.size(kept) > 0).alias("some"))

    return let(F.filter(parts, lambda part: part["some"]), join)
