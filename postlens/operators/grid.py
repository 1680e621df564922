"""Rectangles over two whole-number columns: the points inside them, and the cells that cover them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SIZE_STEP = 4
TOP_SIZE = 63
BOX = ("x_lo", "x_hi", "y_lo", "y_hi")
# Single points count as cells of this level.
POINTS = -1


def _size(lo: str, hi: str) -> Column:
    """Cell size, as a power of two, for a range: it then touches one or two cells."""
    width = F.try_subtract(F.col(hi), F.col(lo))
    bits = F.when(width == 0, 0).otherwise(F.length(F.bin(width)))
    stepped = F.ceil(bits / SIZE_STEP) * SIZE_STEP
    return F.least(F.coalesce(stepped, F.lit(TOP_SIZE)), F.lit(TOP_SIZE)).cast("int")


def shift_right(value: Column, bits: Column | int) -> Column:
    return F.call_function("shiftright", value, bits if isinstance(bits, Column) else F.lit(bits))


def meet(rects: DataFrame, points: DataFrame, x: str, y: str, same: Sequence[str] = ()) -> DataFrame:
    """A row for every point inside a rectangle, all ends included, with the other columns of both.

    ``rects`` has ``x_lo, x_hi, y_lo, y_hi``, ``points`` the columns ``x`` and ``y``; the columns
    ``same`` of both must be equal.

    A rectangle picks a cell size to fit its ranges and so lies in one to four cells, however
    wide it is. A point lies in one cell of each size in use; there are few sizes, at most
    17 x 17. Both meet by cell, and the exact ranges are checked then. Rectangles in usual number
    are broadcast by the planner; beyond that, adaptive execution cuts the partition of a
    crowded cell, as nothing after the join relies on its partitioning.
    """
    cell = ["x_size", "y_size", "x_at", "y_at"]
    sized = rects.withColumns({"x_size": _size("x_lo", "x_hi"), "y_size": _size("y_lo", "y_hi")})
    for at, size, lo, hi in (("x_at", "x_size", "x_lo", "x_hi"), ("y_at", "y_size", "y_lo", "y_hi")):
        ends = F.sequence(shift_right(F.col(lo), F.col(size)), shift_right(F.col(hi), F.col(size)))
        sized = sized.withColumn(at, F.explode(ends))
    sizes = sized.agg(F.collect_set(F.struct("x_size", "y_size")).alias("sizes")).scalar()
    placed = (
        points.withColumn("size", F.explode(sizes))
        .withColumns({"x_size": F.col("size.x_size"), "y_size": F.col("size.y_size")})
        .withColumns({"x_at": shift_right(F.col(x), F.col("x_size")), "y_at": shift_right(F.col(y), F.col("y_size"))})
        .drop("size")
    )
    inside = F.col(x).between(F.col("x_lo"), F.col("x_hi")) & F.col(y).between(F.col("y_lo"), F.col("y_hi"))
    return placed.join(sized, [*same, *cell]).where(inside).drop(*cell, *BOX)


@dataclass(frozen=True)
class Grid:
    """Nested cells: ``bits[level]`` are the powers of two of a cell's width and height.

    Level 0 is the finest; every level must be coarser than the one before. The default suits
    user ids and seconds: from 4 users by 4.5 hours to 1,024 users by 48 days.
    """

    bits: tuple[tuple[int, int], ...] = ((2, 14), (4, 16), (6, 18), (8, 20), (10, 22))

    def __post_init__(self) -> None:
        for (x, y), (x_next, y_next) in zip(((0, 0), *self.bits), self.bits):
            if not (x <= x_next < 63 and y <= y_next < 63 and (x, y) != (x_next, y_next)):
                raise ValueError(f"cells must grow from level to level: {self.bits}")

    def place(self, x: Column, y: Column, level: int, below: int = POINTS) -> tuple[Column, Column]:
        """The cell at ``level`` that holds a point, or a cell of the level ``below``."""
        x_from, y_from = (0, 0) if below == POINTS else self.bits[below]
        return shift_right(x, self.bits[level][0] - x_from), shift_right(y, self.bits[level][1] - y_from)


def _whole_cells(lo: Column, hi: Column, bits: int) -> tuple[Column, Column]:
    """First and last cell that lie wholly inside a range; the last is before the first if none does."""
    rest = F.lit((1 << bits) - 1).cast("bigint")
    first = shift_right(lo, bits) + F.when(lo.bitwiseAND(rest) == 0, 0).otherwise(1)
    last = shift_right(hi, bits) - F.when(hi.bitwiseAND(rest) == rest, 0).otherwise(1)
    return first, last


def _parts_of(first: Column, last: Column, step: int) -> tuple[Column, Column]:
    """A range of cells in cells that are ``step`` powers of two smaller."""
    rest = F.lit((1 << step) - 1).cast("bigint")
    low, high = (F.call_function("shiftleft", cell.cast("bigint"), F.lit(step)) for cell in (first, last))
    return low, high.bitwiseOR(rest)


def _frame(level: int, outer: Sequence[Column], inner: Sequence[Column] | None) -> list[Column]:
    """Up to four boxes that make up ``outer`` without ``inner``; ends before starts where one is empty."""

    def box(x_lo: Column, x_hi: Column, y_lo: Column, y_hi: Column) -> Column:
        sides = zip(BOX, (x_lo, x_hi, y_lo, y_hi))
        return F.struct(F.lit(level).alias("level"), *[side.cast("bigint").alias(name) for name, side in sides])

    a, b, c, d = outer
    if inner is None:
        return [box(a, b, c, d)]
    p, q, r, s = inner
    hollow = (p <= q) & (r <= s)

    def if_hollow(part: Column, full: Column) -> Column:
        return F.when(hollow, part).otherwise(full)

    def before(side: Column) -> Column:
        return F.try_subtract(side, F.lit(1).cast("bigint"))

    def after(side: Column) -> Column:
        return F.try_add(side, F.lit(1).cast("bigint"))

    # At the ends of the numbers there is nothing before or after: the side is null, and the box empty.
    nothing = F.lit(None).cast("bigint")
    return [
        box(a, if_hollow(before(p), b), c, d),
        box(if_hollow(after(q), nothing), b, c, d),
        box(if_hollow(p, nothing), q, c, before(r)),
        box(if_hollow(p, nothing), q, after(s), d),
    ]


def cover(rects: DataFrame, grid: Grid) -> DataFrame:
    """Every rectangle as few boxes of whole cells and of single points, with ``level`` and the other columns.

    Each box counts in cells of its level. The cells of the coarsest level that lie inside are
    taken whole; around them a frame of cells of the next finer level, and so on; what is left at
    the rim are boxes of points, at level ``POINTS``. Boxes of a rectangle do not overlap.
    """
    x_lo, x_hi, y_lo, y_hi = (F.col(c) for c in BOX)
    boxes = [(x_lo, x_hi, y_lo, y_hi)]
    for x_bits, y_bits in grid.bits:
        boxes.append((*_whole_cells(x_lo, x_hi, x_bits), *_whole_cells(y_lo, y_hi, y_bits)))
    sizes = [(0, 0), *grid.bits]
    parts = []
    for n, outer in enumerate(boxes):
        inner = None
        if n + 1 < len(boxes):
            steps = [after - own for own, after in zip(sizes[n], sizes[n + 1])]
            p, q, r, s = boxes[n + 1]
            inner = (*_parts_of(p, q, steps[0]), *_parts_of(r, s, steps[1]))
        parts += _frame(n - 1, outer, inner)
    real = F.filter(F.array(*parts), lambda b: (b["x_lo"] <= b["x_hi"]) & (b["y_lo"] <= b["y_hi"]))
    rest = [c for c in rects.columns if c not in BOX]
    return rects.select(*rest, F.inline(real))
