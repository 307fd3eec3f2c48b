"""Recognised lines of a screen: a band join in two dimensions, and the catalogue rows read from where lines stand.

A line is a box with a text. Boxes fall into cells of a grid; each anchor asks in all cells that its window touches, so the
join is on equality of page and cell, and the exact test comes after. Cells with more than DENSE boxes are dealt into
shares of their boxes, and the anchors of such a cell ask each share, so that a crowded cell is the work of many tasks.

Catalogue rows need all lines of an anchor's window together, so there the stretch of the page that an anchor stands in holds
every line that it may need. Lines are shuffled once, sorted by height, and met in one pass over the sorted rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from prodlake.functions.text import blank, compact, trim_space
from prodlake.session import lean_batches

#: Boxes of a cell that one share holds.
DENSE = 4096
#: Window heights in a stretch of a page: one line in so many is sent to the stretch beside its own, too.
STRETCH = 16
#: Lines that are met at a time, and pairs of a price and a line.
AT_ONCE, PAIRS = 1 << 14, 1 << 18
# Places and texts of the screens that the catalogue is read from.
PRICE_FROM, NAME_TO, CATEGORY_TO = 750, 760, 420
SAME_ROW, CATEGORY_NEAR, CATEGORY_FAR, CATEGORY_AT, CATEGORY_LENGTH = 52, 42, 118, 78, 16
LEAST_CONFIDENCE, LEAST_PRICE, MOST_PRICE = 0.45, 100, 10_000_000
PRICE = r"^\d{1,3}(?:,\d{3})*$"
SIZE = (
    r"(?is)^(.*?)(?:\s+|^)(\d+(?:\.\d+)?\s*"
    r"(?:mg|g|kg|ml|l|정|캡슐|연질캡슐|포|병|개|매|EA|ea|T|C|c|정제|캅셀|롤|스틱|박스|통|세트|입))$"
)
BUTTONS = ("검색", "초기화")
NO_CATEGORY = "미분류"


@dataclass(frozen=True)
class Window2:
    """What may lie between an anchor and a box: dx = box.x - anchor.x from left to right, dy likewise; None is no bound.

    A side without bounds needs no cells of its own.
    """

    top: float
    bottom: float
    left: float | None = None
    right: float | None = None


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size).cast("long"), F.floor(high / size).cast("long"))


def band_pairs(anchors: DataFrame, boxes: DataFrame, pages: list[str], x: str, y: str, window: Window2) -> DataFrame:
    """J-12: pairs of an anchor and a box of its page whose centre lies in the anchor's window, bounds included.

    anchors and boxes have the page columns, x and y (numbers), and otherwise columns of different names; boxes'
    `x` and `y` come back as box_x and box_y. Rows with a null page or place are in no pair.
    """
    wide = window.left is not None and window.right is not None
    height = max(window.bottom - window.top, 1.0)
    width = max(window.right - window.left, 1.0) if wide else 1.0
    column = F.floor(F.col("box_x") / width).cast("long") if wide else F.lit(0).cast("long")
    named = boxes.withColumnsRenamed({x: "box_x", y: "box_y"})
    placed = named.withColumns({"_cy": F.floor(F.col("box_y") / height).cast("long"), "_cx": column})
    cell = [*pages, "_cy", "_cx"]
    dense = placed.groupBy(*cell).agg(F.count("*").alias("_n")).where(F.col("_n") > DENSE).select(*cell, F.ceil(F.col("_n") / DENSE).cast("int").alias("_shares"))
    dense = F.broadcast(dense)  # a row for DENSE boxes at most, so that neither side is shuffled to learn its shares
    own = [F.col(c) for c in named.columns if c not in pages]
    dealt = placed.join(dense, cell, "left").withColumn("_share", F.when(F.col("_shares").isNull(), 0).otherwise(F.pmod(F.xxhash64(*own), F.col("_shares")).cast("int")))
    asking = anchors.withColumn("_cy", F.explode(_cells(F.col(y) + window.top, F.col(y) + window.bottom, height)))
    asking = asking.withColumn("_cx", F.explode(_cells(F.col(x) + window.left, F.col(x) + window.right, width)) if wide else F.lit(0).cast("long"))
    asking = asking.join(dense, cell, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)))
    # by a merge at every size: boxes that are broadcast only while they are few would hide what growth costs
    met = asking.drop("_shares").hint("merge").join(dealt.drop("_shares"), [*cell, "_share"]).drop("_cy", "_cx", "_share")
    dy, dx = F.col("box_y") - F.col(y), F.col("box_x") - F.col(x)
    inside = (dy >= window.top) & (dy <= window.bottom)
    return met.where(inside & (dx >= window.left) & (dx <= window.right) if wide else inside)


def clean_line(text: Column) -> Column:
    """A recognised text: a bar read for an l, the unit sign spelled out, single spaces."""
    return trim_space(F.regexp_replace(F.replace(F.replace(blank(text), F.lit("|"), F.lit("l")), F.lit("㎖"), F.lit("ml")), r"\s+", " "))


class _Sweep:
    """Lines of one task by page, stretch, share and height: each price meets the lines in its window as soon as all have come.

    Columns: pages, _stretch, _share, _at, _use, place, price, text, score, x1. Heights are doubled, so that middles are whole.
    """

    def __init__(self, pages: int, height: int):
        self.pages, self.room = pages, height + 8 * (SAME_ROW + CATEGORY_FAR)
        self.rest: list[pa.RecordBatch] = []
        self.done = 0  # rows of the rest whose prices are read

    def _order(self, table: pa.Table) -> np.ndarray:
        """One rising number for page, stretch, share and height; windows of two stretches are apart."""
        new = np.zeros(table.num_rows, dtype=bool)
        for k in range(self.pages + 2):
            values = table.column(k)
            new[1:] |= np.asarray(pc.not_equal(values.slice(1), values.slice(0, table.num_rows - 1)))
        return np.cumsum(new) * self.room + np.asarray(table.column("_at"))

    def over(self, batches: list[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(self.rest + batches).combine_chunks()
        order = self._order(table)
        ready = len(order) if last else int(np.searchsorted(order, order[-1] - 2 * CATEGORY_FAR))
        ready = max(ready, self.done)
        asking = np.flatnonzero(np.asarray(pc.is_valid(table.column("price")))[self.done : ready]) + self.done
        low = np.searchsorted(order, order[asking] - 2 * SAME_ROW)
        high = np.searchsorted(order, order[asking] + 2 * CATEGORY_FAR, "right")
        if len(asking):
            place = np.asarray(pc.rank(table.column("place"), null_placement="at_start", tiebreaker="dense")).astype(np.int64)
            part = np.cumsum(high - low) // PAIRS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(asking)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield self._rows(table, place, asking[a:b], low[a:b], high[a:b])
        if not last:
            keep = int(np.searchsorted(order, order[ready] - 2 * SAME_ROW))
            self.rest, self.done = table.slice(keep).to_batches(), ready - keep

    def _rows(self, table: pa.Table, place: np.ndarray, asking: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        n, count = len(asking), high - low
        who = np.repeat(np.arange(n), count)
        line = np.arange(len(who)) + np.repeat(low - (np.cumsum(count) - count), count)
        at, use, x = (np.asarray(table.column(c)) for c in ("_at", "_use", "x1"))
        dy = at[line] - at[asking][who]
        row = np.flatnonzero((use[line] & 1 > 0) & (np.abs(dy) <= 2 * SAME_ROW))
        row = row[np.lexsort((place[line[row]], x[line[row]], who[row]))]
        below = np.flatnonzero((use[line] & 2 > 0) & (dy >= 2 * CATEGORY_NEAR))
        below = below[np.lexsort((place[line[below]], x[line[below]], np.abs(dy[below] - 2 * CATEGORY_AT), who[below]))]
        nearest = np.full(n, -1)
        owner, first = np.unique(who[below], return_index=True)
        nearest[owner] = line[below[first]]
        lengths = np.bincount(who[row], minlength=n)
        own, nearest = asking[lengths > 0], nearest[lengths > 0]
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths[lengths > 0])]), pa.int32())
        column = lambda name, at: table.column(name).take(at).combine_chunks()
        told = {name: column(name, pa.array(own)) for name in [*table.column_names[: self.pages], "place", "price", "score"]}
        told |= {f"row_{name}": pa.ListArray.from_arrays(ends, column(name, pa.array(line[row]))) for name in ("text", "score")}
        return pa.RecordBatch.from_pydict(told | {f"below_{name}": column(name, pa.array(nearest, mask=nearest < 0)) for name in ("text", "score")})


def _swept(batches: Iterator[pa.RecordBatch], pages: int, height: int) -> Iterator[pa.RecordBatch]:
    sweep, held, rows = _Sweep(pages, height), [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= max(AT_ONCE, sum(b.num_rows for b in sweep.rest)):  # what is kept is copied no more often than it grows
            yield from sweep.over(held, False)
            held, rows = [], 0
    if held or sweep.rest:
        yield from sweep.over(held, True)


def _met(usable: DataFrame, pages: list[str]) -> DataFrame:
    """Every price with the lines of its row, from left to right, and the line below: (pages, place, price, score, row_text,
    row_score, below_text, below_score), without prices whose row has no lines.

    usable: pages, place, text, score, x1, middle (the doubled height of a line's middle). A stretch of a page with more than
    DENSE lines to the left is dealt into shares of its prices; each share gets all lines of the stretch.
    """
    height = 2 * STRETCH * (SAME_ROW + CATEGORY_FAR)
    digits = F.replace("text", F.lit(" "), F.lit(""))
    price = F.when((F.col("x1") >= PRICE_FROM) & digits.rlike(PRICE), F.replace(digits, F.lit(","), F.lit("")).try_cast("long"))
    use = F.when((F.col("x1") < NAME_TO) & ~F.col("text").isin(*BUTTONS), 1).otherwise(0) + F.when((F.col("x1") < CATEGORY_TO) & (F.length("text") <= CATEGORY_LENGTH), 2).otherwise(0)
    at = lambda middle: F.floor(middle / height).cast("long")
    facts = usable.withColumns({"price": price, "_use": use, "_own": at(F.col("middle"))})
    facts = facts.withColumn("price", F.when(F.col("price").between(LEAST_PRICE, MOST_PRICE), F.col("price")))
    reached = F.sequence(at(F.col("middle") - 2 * CATEGORY_FAR), at(F.col("middle") + 2 * SAME_ROW))
    sent = facts.withColumn("_stretch", F.explode(F.when(F.col("_use") > 0, reached).when(F.col("price").isNotNull(), F.array("_own"))))
    cell = [*pages, "_stretch"]
    counted = usable.where(F.col("x1") < NAME_TO).select(*pages, F.explode(reached).alias("_stretch")).groupBy(*cell).agg(F.count("*").alias("_n"))
    dense = counted.where(F.col("_n") > DENSE).select(*cell, F.ceil(F.col("_n") / DENSE).cast("int").alias("_shares"))
    dealt = sent.join(F.broadcast(dense), cell, "left").withColumn("_shares", F.coalesce("_shares", F.lit(1)))
    dealt = dealt.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    asks = (F.col("_stretch") == F.col("_own")) & (F.pmod(F.xxhash64("place"), F.col("_shares")) == F.col("_share"))
    dealt = dealt.select(
        *cell,
        "_share",
        (F.col("middle") - F.col("_stretch") * height).cast("int").alias("_at"),
        "_use",
        "place",
        F.when(asks, F.col("price")).alias("price"),
        F.when(F.col("_use") > 0, F.col("text")).alias("text"),
        "score",
        "x1",
    )
    ordered = dealt.where((F.col("_use") > 0) | F.col("price").isNotNull()).repartition(*cell, "_share").sortWithinPartitions(*cell, "_share", "_at")
    told = StructType([ordered.schema[c] for c in (*pages, "place", "price", "score")])
    told = told.add("row_text", ArrayType(StringType())).add("row_score", ArrayType(DoubleType())).add("below_text", "string").add("below_score", "double")
    n = len(pages)
    return ordered.mapInArrow(lambda b: _swept(b, n, height), told)


def catalogue_lines(lines: DataFrame, pages: list[str], place: str) -> DataFrame:
    """The catalogue rows of pages of recognised lines: (pages, place, price, name, specification, category, confidence, n_lines).

    lines: page columns, `place` (the order of a page's lines, each once), text, score, x1, y1, x2, y2 (whole numbers). Every price to
    the right begins a row: lines to its left at its height are the name, from left to right; the category is the line
    below that is nearest to where it should be. confidence is the mean of all lines used, to four places.
    """
    lean_batches(lines.sparkSession)
    # a filter over a text that is made moves below the making and makes it once more: blank lines go as they came
    told = lines.where((F.col("score") >= LEAST_CONFIDENCE) & F.col("text").rlike(r"(?U)\S"))
    texts = told.select(*pages, F.col(place).alias("place"), clean_line(F.col("text")).alias("text"), F.col("score").cast("double").alias("score"), *[F.col(c).cast("long").alias(c) for c in ("x1", "y1", "x2", "y2")])
    usable = texts.select(*pages, "place", "text", "score", "x1", (F.col("y1") + F.col("y2")).alias("middle"))
    for c in (*pages, "x1", "middle"):  # told here, as joins would tell it to one side of theirs alone, and lines would be made for each
        usable = usable.where(F.col(c).isNotNull())
    found = _met(usable, pages)
    raw = clean_line(F.array_join("row_text", " "))
    named = found.withColumn("_raw", raw).withColumns({"_before": trim_space(F.regexp_extract("_raw", SIZE, 1)), "_size": clean_line(F.regexp_extract("_raw", SIZE, 2))})
    used = F.concat(F.array("score"), "row_score", F.when(F.col("below_text").isNotNull(), F.array("below_score")).otherwise(F.array().cast("array<double>")))
    mean = F.aggregate(used, F.lit(0.0), lambda a, s: a + s) / F.size(used)
    name = F.when((F.col("_size") == "") | (F.col("_before") == ""), F.col("_raw")).otherwise(F.col("_before"))
    whole = (F.length(compact(F.col("_name"))) >= 2) & F.col("_name").rlike("[A-Za-z가-힣]")
    return named.withColumn("_name", name).select(
        *pages,
        "place",
        "price",
        F.explode(F.when(whole, F.array("_name"))).alias("name"),  # no filter, for the same reason
        F.col("_size").alias("specification"),
        F.coalesce("below_text", F.lit(NO_CATEGORY)).alias("category"),
        F.bround(mean, 4).alias("confidence"),
        F.size(used).alias("n_lines"),
    )
