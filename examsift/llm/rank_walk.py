"""One ranking from several differently-scaled scores.

A walker stands on an item, picks one of the item's scores and jumps to an item chosen uniformly among
those ranked higher by that score (it stays where it is if none is higher). With probability 1 - damping
it jumps anywhere instead. Items are ordered by how often the walker is there. Only ranks matter, so no
score weighs more for its range, gaps or shape.

Items with the same scores are alike to the walker, so the state is one row per distinct combination of
scores. What an item gets in a step depends, per score, on its value alone: prefix sums over the sorted values.
An item at the top of a score keeps what it would have sent there, a fixed share of its mass. So the masses of
all items follow from one sum per value of each score and share kept (``Sums``). These are held on the
driver, up to a checked number of values; states are read in each step, but never moved or written again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.operators.prefix import running_sums
from examsift.operators.sizing import broadcast_if_small
from examsift.runtime import cut_lineage

#: Distinct combinations of scores (some 40 bytes each) up to which the walk is iterated without a job per step.
DRIVER_STATES = 1_000_000
#: Distinct values of all scores (some 100 bytes each) up to which their sums are held on the driver; more are walked over by tables.
MOST_VALUES = 2_000_000


def item_scores() -> dict[str, Column]:
    """The scores of generated items, each so that more is better: novel, hard for solvers, difficult.

    Values outside a score's range (sentinels), NaN and nulls count as no score.
    """
    novelty, accuracy, difficulty = F.col("novelty_score"), F.col("solver_accuracy"), F.col("difficulty").cast("double")
    return {
        "novelty": F.when(~F.isnan(novelty) & novelty.between(0, 100), novelty),
        "hardness": F.when(~F.isnan(accuracy) & accuracy.between(0, 1), -accuracy),
        "difficulty": F.when(difficulty.between(1, 5), difficulty),
    }


class Sums:
    """What the walk knows of each score: its distinct values in order, the items above each, and the sums that give the mass of
    any item with such values."""

    def __init__(self, values: list[np.ndarray], counts: list[np.ndarray], items: float, damping: float):
        self.values, self.items, self.damping = values, items, damping
        self.above = [c.sum() - np.cumsum(c) for c in counts]
        k = len(values)
        #: Shares of its mass that an item keeps: by the number of its scores and of those at the top.
        self.kept = {(own, top): damping * top / own if own else 0.0 for own in range(k + 1) for top in range(own + 1)}
        self.number = {key: n for n, key in enumerate(self.kept)}
        self.base = np.full(len(self.kept), 1 / items)
        self.gains = [np.zeros((len(self.kept), len(v))) for v in values]

    def place(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, own, number): place of each value (-1 for none), scores an item has, its share kept. ``scores``: items x scores, NaN for none."""
        has = ~np.isnan(scores)
        codes = np.stack([np.where(has[:, k], np.searchsorted(v, scores[:, k]), -1) for k, v in enumerate(self.values)], axis=1) if len(scores) else np.empty((0, len(self.values)), np.int64)
        top = sum(((codes[:, k] == len(v) - 1) & has[:, k]).astype(np.int64) for k, v in enumerate(self.values))
        own = has.sum(axis=1)
        lookup = np.zeros((len(self.values) + 1, len(self.values) + 1), np.int64)
        for (o, t), n in self.number.items():
            lookup[o, t] = n
        return codes, own, lookup[own, top]

    def mass(self, codes: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Probability of one item at each place."""
        out = self.base[number].copy()
        for k, gain in enumerate(self.gains):
            has = codes[:, k] >= 0
            out[has] += gain[number[has], codes[has, k]]
        return out

    def flows(self, codes: np.ndarray, own: np.ndarray, number: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What leaves each value of each score, one behind the other, and at the end the mass of items without a score."""
        mass = self.mass(codes, number) * n
        out = []
        for k, v in enumerate(self.values):
            has = codes[:, k] >= 0
            out.append(np.bincount(codes[has, k], mass[has] / own[has], len(v)))
        return np.concatenate([*out, [mass[own == 0].sum()]])

    def step(self, flows: np.ndarray) -> None:
        """Go on by one step, given the flows of all items."""
        kept = np.array(list(self.kept.values()))
        self.base = kept * self.base + self.damping * flows[-1] / self.items + (1 - self.damping) / self.items
        at = 0
        for k, above in enumerate(self.above):
            out = flows[at : at + len(above)]
            at += len(above)
            sent = np.divide(out, above, out=np.zeros_like(out), where=above > 0)
            reached = np.cumsum(sent) - sent  # what each item of a value gets from all lower values
            self.gains[k] = kept[:, None] * self.gains[k] + self.damping * reached


def _iterate(sums: Sums, flows: Callable[[], np.ndarray], steps: int, tolerance: float) -> None:
    before = None
    for _ in range(steps):
        now = flows()
        sums.step(now)
        if before is not None and np.abs(now - before).sum() < tolerance:
            break
        before = now


def _numbers(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    return np.stack([columns[n].to_numpy(zero_copy_only=False).astype(float) for n in names], axis=1) if names else np.empty((batch.num_rows, 0))


def _walk_by_sums(states: DataFrame, names: list[str], damping: float, steps: int, tolerance: float, on_driver: bool, values: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """One narrow job per step (none with few states): each task adds up the flows of its states."""
    items = float(states.agg(F.coalesce(F.sum("_n"), F.lit(0.0))).first()[0])
    if not items:
        return states.select("_state", F.lit(0.0).alias("stationarity"))
    sums = Sums([v for v, _ in values], [c for _, c in values], items, damping)
    lean = states.select("_n", *names)
    if on_driver:
        pdf = lean.toPandas()
        codes, own, number = sums.place(pdf[names].to_numpy(dtype=float))
        n = pdf["_n"].to_numpy(dtype=float)
        _iterate(sums, lambda: sums.flows(codes, own, number, n), steps, tolerance)
    else:

        def over_tasks() -> np.ndarray:
            def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = None
                for batch in batches:
                    codes, own, number = sums.place(_numbers(batch, names))
                    part = sums.flows(codes, own, number, _numbers(batch, ["_n"])[:, 0])
                    total = part if total is None else total + part
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["flows"])

            return sum(np.frombuffer(r.flows) for r in lean.mapInArrow(add, "flows binary").collect())  # one row per task, of as many numbers as there are values

        _iterate(sums, over_tasks, steps, tolerance)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _, number = sums.place(_numbers(batch, names))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums.mass(codes, number))], ["_state", "stationarity"])

    return states.select("_state", *names).mapInArrow(finish, "_state string, stationarity double")


def _values_of(states: DataFrame, names: list[str], most: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Distinct values of each score in order with their items; None if there are more than ``most`` in all."""
    long = states.select("_n", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("v")) for k, n in enumerate(names)])).alias("s")).filter("s.v is not null")
    counted = cut_lineage(long.groupBy("s.k", "s.v").agg(F.sum("_n").alias("n")))
    if counted.count() > most:
        return None
    pdf = counted.toPandas()
    out = []
    for k in range(len(names)):
        own = pdf[pdf["k"] == k].sort_values("v")
        out.append((own["v"].to_numpy(dtype=float), own["n"].to_numpy(dtype=float)))
    return out


def _walk_by_tables(states: DataFrame, names: list[str], damping: float, steps: int, tolerance: float) -> DataFrame:
    """For scores of very many values: the same steps as range-partitioned prefix sums over tables."""
    owned = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    n = states.agg(F.sum("_n")).first()[0]
    mass = cut_lineage(states.withColumn("_owned", owned).withColumn("_mass", F.col("_n") / F.lit(float(n))))
    for _ in range(steps):
        lost = mass.filter("_owned = 0").agg(F.coalesce(F.sum("_mass"), F.lit(0.0))).first()[0]
        new = mass.withColumn("_new", F.lit(0.0))
        for name in names:
            values = mass.filter(F.col(name).isNotNull()).groupBy(name).agg(F.sum("_n").alias("_c"), F.sum(F.col("_mass") / F.col("_owned")).alias("_out"))
            up = running_sums(values, [F.col(name).desc()], {"_upto": F.col("_c")})
            sent = up.withColumn("_above", F.col("_upto") - F.col("_c")).withColumn("_sent", F.when(F.col("_above") > 0, F.col("_out") / F.col("_above")).otherwise(0.0))
            reached = running_sums(sent.select(name, "_above", "_sent"), [F.col(name)], {"_sum": F.col("_sent")})
            reached = reached.select(F.col(name).alias("_v"), "_above", (F.col("_sum") - F.col("_sent")).alias("_got"))
            gain = F.coalesce(F.col("_n") * F.col("_got") + F.when(F.col("_above") == 0, F.col("_mass") / F.col("_owned")).otherwise(0.0), F.lit(0.0))
            new = new.join(reached, F.col(name) == F.col("_v"), "left").withColumn("_new", F.col("_new") + gain).drop("_v", "_above", "_got")
        total = damping * (F.col("_new") + F.col("_n") * F.lit(lost / n)) + F.lit((1 - damping) / n) * F.col("_n")
        after = cut_lineage(new.withColumn("_after", total))
        change = after.agg(F.sum(F.abs(F.col("_after") - F.col("_mass")))).first()[0]
        mass = after.drop("_new", "_mass").withColumnRenamed("_after", "_mass")
        if change is not None and change < tolerance:
            break
    return mass.select("_state", (F.col("_mass") / F.col("_n")).alias("stationarity"))


def rank_walk(items: DataFrame, scores: dict[str, Column], ident: str = "item_ord", damping: float = 0.85, steps: int = 200, tolerance: float = 1e-13, driver_states: int = DRIVER_STATES, most_values: int = MOST_VALUES) -> DataFrame:
    """(``ident``, stationarity, rank): every row of ``items`` with its place in the common order.

    ``stationarity`` is how often the walker is at the item, as a multiple of an equal share, to nine places. Items with
    equal scores tie and share a rank (1 + the number of items before them); ``ident``
    settles the order among them. An item with no score at all is only reached by the jumps that go
    anywhere and comes last. An empty table gives an empty result.
    """
    names = [f"_s{k}" for k in range(len(scores))]
    scored = items.select(F.col(f"`{ident}`").alias(ident), *[e.cast("double").alias(n) for n, e in zip(names, scores.values())])
    key = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names])
    scored = scored.withColumn("_state", key)
    states = cut_lineage(scored.groupBy("_state", *names).agg(F.count(F.lit(1)).cast("double").alias("_n")))
    n = states.agg(F.coalesce(F.sum("_n"), F.lit(0.0)), F.count(F.lit(1))).first()
    values = _values_of(states, names, most_values)
    if values is None:
        walk = _walk_by_tables(states, names, damping, steps, tolerance)
    else:
        walk = _walk_by_sums(states, names, damping, steps, tolerance, n[1] <= driver_states, values)
    placed = cut_lineage(states.select("_state", "_n").join(walk, "_state").withColumn("stationarity", F.round(F.col("stationarity") * F.lit(n[0]), 9)))
    level = placed.groupBy("stationarity").agg(F.sum("_n").alias("_c"))
    ranks = running_sums(level, [F.col("stationarity").desc()], {"_upto": F.col("_c")})
    ranks = ranks.select("stationarity", (F.col("_upto") - F.col("_c") + 1).cast("long").alias("rank"))
    found = placed.select("_state", "stationarity").join(ranks, "stationarity")
    return scored.select(ident, "_state").join(broadcast_if_small(found), "_state").select(ident, "stationarity", "rank")
