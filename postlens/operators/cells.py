"""Posts and words added up in nested cells of users and time.

What a request over wide ranges needs from the posts of a whole cell is held by the cell: how
many posts there are, and for each word the posts that hold it, their weight, and the best of them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from postlens.operators.grid import Grid
from postlens.operators.topics import ADDENDS, VARIANTS, summed, with_addends

CELL = ("level", "u_cell", "t_cell")


class Cells(NamedTuple):
    """``totals``: ``[level, u_cell, t_cell, posts]``; ``words``: also ``word, weight_high, weight_low, best``.

    The weight is kept in its two summands, so that cells add up exactly. ``best`` is the greatest ``(impact, post_id)`` of the cell's posts with the word.
    """

    totals: DataFrame
    words: DataFrame


def _placed(df: DataFrame, grid: Grid) -> DataFrame:
    u_cell, t_cell = grid.place(F.col("user_id"), F.col("created_at"), 0)
    return df.withColumns({"level": F.lit(0), "u_cell": u_cell, "t_cell": t_cell})


def finest_totals(posts: DataFrame, grid: Grid) -> DataFrame:
    return _placed(posts, grid).groupBy(*CELL).agg(F.count("*").alias("posts"))


def finest_words(words: DataFrame, grid: Grid, variant: str = VARIANTS[0]) -> DataFrame:
    """Level 0 from word rows: merged before the shuffle, like all levels above."""
    return _placed(with_addends(words, variant), grid).groupBy(*CELL, "word").agg(
        F.count("*").alias("posts"),
        *map(summed, ADDENDS),
        F.max(F.struct("impact", "post_id")).alias("best"),
    )


def _raised(cells: DataFrame, grid: Grid, level: int) -> DataFrame:
    u_cell, t_cell = grid.place(F.col("u_cell"), F.col("t_cell"), level, level - 1)
    return cells.withColumns({"level": F.lit(level), "u_cell": u_cell, "t_cell": t_cell})


def coarser_totals(totals: DataFrame, grid: Grid, level: int) -> DataFrame:
    """The cells of a level from those of the level below."""
    return _raised(totals, grid, level).groupBy(*CELL).agg(F.sum("posts").alias("posts"))


def coarser_words(words: DataFrame, grid: Grid, level: int) -> DataFrame:
    return _raised(words, grid, level).groupBy(*CELL, "word").agg(
        *map(summed, ("posts", *ADDENDS)),
        F.max("best").alias("best"),
    )


def cells_of(posts: DataFrame, words: DataFrame, grid: Grid, variant: str = VARIANTS[0]) -> Cells:
    """All levels in one plan; each is made from the one below. The topic job stores them instead."""
    totals, weights = [finest_totals(posts, grid)], [finest_words(words, grid, variant)]
    for level in range(1, len(grid.bits)):
        totals.append(coarser_totals(totals[-1], grid, level))
        weights.append(coarser_words(weights[-1], grid, level))
    all_totals, all_weights = totals[0], weights[0]
    for t, w in zip(totals[1:], weights[1:]):
        all_totals, all_weights = all_totals.unionByName(t), all_weights.unionByName(w)
    return Cells(all_totals, all_weights)


def with_cells(posts: DataFrame, grid: Grid) -> DataFrame:
    """Every post once for each level, with its cell there."""
    places = []
    for level in range(len(grid.bits)):
        u_cell, t_cell = grid.place(F.col("user_id"), F.col("created_at"), level)
        places.append(F.struct(F.lit(level).alias("level"), u_cell.alias("u_cell"), t_cell.alias("t_cell")))
    return posts.select("*", F.inline(F.array(*places)))
