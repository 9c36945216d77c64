"""A sample whose categories match target proportions.

Records are grouped by their signature (the cell of question type, subtype and difficulty they fall
into). The plan works on counts of signatures alone: it starts from a random sample that satisfies the
floors and exchanges rows between cells as long as the deviation from the targets falls. Only then are
records drawn, at random within each cell.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examsift.operators.sizing import broadcast_if_small

CELL = ["question_type", "subtype", "difficulty"]
#: Cells of the target table the plan accepts: the plan is made on the driver from one count per cell.
MOST_CELLS = 100_000
#: Rows of a cell that share a part of the random order, on average; only one part per cell is sorted.
ROWS_A_PART = 5_000


def tidy(name: Column) -> Column:
    """Trimmed, in lower case, each run of spaces or hyphens as one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"^\s+|\s+$", ""), r"[\s\-]+", "_")


def with_cells(df: DataFrame) -> DataFrame:
    return df.withColumns({"question_type": tidy(F.col("question_type")), "subtype": tidy(F.col("subtype"))})


def held_floors(floors: list[int], available: list[int], size: int) -> list[int]:
    """Floors a sample of ``size`` rows can hold: no more than a cell has and, if all together exceed the sample, shares of it
    in proportion (largest remainders first, then the order of cells)."""
    held = [min(f, a) for f, a in zip(floors, available)]
    total = sum(held)
    if total <= size:
        return held
    shares = [h * size // total for h in held]
    by_remainder = sorted(range(len(held)), key=lambda i: (-(held[i] * size % total), i))
    for i in by_remainder[: size - sum(shares)]:
        shares[i] += 1
    return shares


def start_sample(available: list[int], floors: list[int], size: int, draw: random.Random) -> list[int]:
    """Rows per cell of a random sample of ``size`` rows (or all, if there are fewer) that holds ``floors``."""
    taken = list(floors)
    left = size - sum(taken)
    rest = [a - t for a, t in zip(available, taken)]
    for i in sorted(range(len(rest)), key=lambda _: draw.random()):
        if left <= 0:
            break
        others = sum(rest)
        # the mean of the hypergeometric draw, rounded at random: totals stay exact
        want = left * rest[i] / others if others else 0
        n = min(rest[i], left, math.floor(want) + (draw.random() < want - math.floor(want)))
        taken[i] += n
        left -= n
        rest[i] = 0
    for i in range(len(taken)):  # what rounding left over
        n = min(max(0, left), available[i] - taken[i])
        taken[i] += n
        left -= n
    return taken


def swap_repair(taken: list[int], wanted: list[int], floors: list[int], available: list[int]) -> list[int]:
    """Exchange rows between cells while that lowers the sum of |taken - wanted|.

    An exchange gives rows of a cell above its target to one below it, as many as both bear; ``floors`` stay
    held. It ends when no exchange improves, after at most one exchange per cell and side.
    """
    taken = list(taken)
    keep = [max(w, f) for w, f in zip(wanted, floors)]
    goal = [min(w, a) for w, a in zip(wanted, available)]
    over = [i for i in range(len(taken)) if taken[i] > keep[i]]
    under = [i for i in range(len(taken)) if taken[i] < goal[i]]
    while over and under:
        i, j = over[-1], under[-1]
        n = min(taken[i] - keep[i], goal[j] - taken[j])
        taken[i] -= n
        taken[j] += n
        if taken[i] <= keep[i]:
            over.pop()
        if taken[j] >= goal[j]:
            under.pop()
    return taken


def sample_plan(items: DataFrame, targets: DataFrame, one_in: int = 5, seed: int = 11) -> DataFrame:
    """Per target cell: rows available, wanted and planned, the floor, and whether and why the plan falls short.

    The sample has floor(rows / ``one_in``) rows, or all rows of target cells if they are fewer. A cell wants
    floor(target_bp * size / 10000) rows and is due the larger of that and min_rows. The plan starts from a random sample
    that holds the floors, as far as cells and sample can, and repairs it by exchanges towards what is due.
    ``short`` says why less than that is planned: ``rows`` if the cell has fewer, ``size`` if the sample has no
    room (floors that exceed it are scaled down in proportion), null if all is planned (``met``). Names of both
    tables are tidied; every row counts, repeated ones too; a null in a cell matches a null. One aggregation,
    combined before its shuffle; at most MOST_CELLS counts reach the driver.
    """
    cells = with_cells(targets).groupBy(*CELL).agg(F.coalesce(F.max("target_bp"), F.lit(0)).alias("target_bp"), F.coalesce(F.max("min_rows"), F.lit(0)).alias("min_rows"))
    goals = cells.orderBy(*CELL).limit(MOST_CELLS + 1).collect()
    if len(goals) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} target cells")
    spark = items.sparkSession
    counted = with_cells(items).groupBy(*CELL).count()
    named = spark.createDataFrame([(i, r.question_type, r.subtype, r.difficulty) for i, r in enumerate(goals)], "cell int, _t string, _s string, _d int")
    match = F.col("_t").eqNullSafe(F.col("question_type")) & F.col("_s").eqNullSafe(F.col("subtype")) & F.col("_d").eqNullSafe(F.col("difficulty"))
    found = {r.cell: r.n for r in counted.join(broadcast_if_small(named), match).groupBy("cell").agg(F.sum("count").alias("n")).collect()}
    size = items.count() // one_in
    available = [found.get(i, 0) for i in range(len(goals))]
    wanted = [r.target_bp * size // 10000 for r in goals]
    due = [max(w, r.min_rows) for w, r in zip(wanted, goals)]
    planned = plan_rows(available, wanted, [r.min_rows for r in goals], size, random.Random(seed))
    rows = []
    for r, w, a, d, p in zip(goals, wanted, available, due, planned):
        short = None if p >= d else "rows" if a < d else "size"
        rows.append((r.question_type, r.subtype, r.difficulty, r.target_bp, r.min_rows, w, a, p, short is None, short))
    kind = "question_type string, subtype string, difficulty int, target_bp int, min_rows int, wanted bigint, available bigint, planned bigint, met boolean, short string"
    return spark.createDataFrame(rows, kind)


def plan_rows(available: list[int], wanted: list[int], floors: list[int], size: int, draw: random.Random) -> list[int]:
    """Planned rows per cell; they sum to ``size`` or to all rows there are."""
    held = held_floors(floors, available, size)
    start = start_sample(available, held, min(size, sum(available)), draw)
    return swap_repair(start, [max(w, h) for w, h in zip(wanted, held)], held, available)


def unmet_cells(items: DataFrame, targets: DataFrame, one_in: int = 5) -> DataFrame:
    """Cells of which the plan, after all exchanges, takes fewer rows than are due because the items have no more."""
    return sample_plan(items, targets, one_in).filter("planned < greatest(wanted, min_rows) and short = 'rows'").select(*CELL)


def draw_sample(items: DataFrame, targets: DataFrame, one_in: int = 5, seed: int = 11, ident: str = "item_ord") -> DataFrame:
    """(``ident``, question_type, subtype, difficulty): the planned rows of each cell, drawn at random.

    The random order is a hash of seed and row. Rows of a cell are counted by parts of that order; whole
    parts below the cell's threshold are taken and only the part on the threshold is sorted, so no cell,
    however large, is ever sorted in one task. Rows without ``ident`` cannot be drawn.
    """
    plan = broadcast_if_small(sample_plan(items, targets, one_in, seed).select(F.col("question_type").alias("_t"), F.col("subtype").alias("_s"), F.col("difficulty").alias("_d"), "planned", "available", F.monotonically_increasing_id().alias("_cell")))
    match = F.col("_t").eqNullSafe(F.col("question_type")) & F.col("_s").eqNullSafe(F.col("subtype")) & F.col("_d").eqNullSafe(F.col("difficulty"))
    order = F.xxhash64(F.lit(seed), F.col(ident))
    parts = F.greatest(F.lit(1), F.ceil(F.col("available") / F.lit(ROWS_A_PART)))
    rows = with_cells(items).filter(F.col(ident).isNotNull()).select(ident, *CELL).join(plan, match).filter("planned > 0")
    rows = rows.withColumn("_order", order).withColumn("_piece", F.floor((F.col("_order").cast("double") / F.lit(2.0**64) + 0.5) * parts).cast("long"))
    rows = rows.select(ident, *CELL, "_order", "_piece", "_cell", "planned")
    counted = rows.groupBy("_cell", "_piece", "planned").count()
    upto = W.partitionBy("_cell").orderBy("_piece").rowsBetween(W.unboundedPreceding, W.currentRow)
    state = counted.withColumn("_upto", F.sum("count").over(upto)).filter((F.col("_upto") >= F.col("planned")) & (F.col("_upto") - F.col("count") < F.col("planned")))
    edges = broadcast_if_small(state.select("_cell", F.col("_piece").alias("_edge"), (F.col("planned") - F.col("_upto") + F.col("count")).alias("_left")))
    placed = rows.join(edges, "_cell")  # one edge per cell: where its planned rows end
    nth = F.row_number().over(W.partitionBy("_cell").orderBy("_order", ident))
    edge = placed.filter("_piece = _edge").withColumn("_nth", nth).filter("_nth <= _left").drop("_nth")
    return placed.filter("_piece < _edge").unionByName(edge).select(ident, *CELL)
