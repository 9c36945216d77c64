import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from examsift.llm import rank_walk as rw
from examsift.llm import sampling as sp


def scores():
    return {"a": F.col("a"), "b": F.col("b")}



def brute(rows, damping=0.85, steps=200):
    n = len(rows)
    p = np.full(n, 1 / n)
    for _ in range(steps):
        new = np.zeros(n)
        for i, scores in enumerate(rows):
            has = [k for k, x in enumerate(scores) if x is not None]
            for k in has:
                up = [j for j in range(n) if rows[j][k] is not None and rows[j][k] > scores[k]] or [i]
                new[up] += p[i] / len(has) / len(up)
            if not has:
                new += p[i] / n
        p = damping * new + (1 - damping) / n
    return p


def random_rows(n=40, seed=2):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(6)]), rng.choice([None, 0.1, 5000.0, 12.5, 7e6])) for _ in range(n)]
    return [(float(a) if a is not None else None, b) for a, b in rows]


def test_walk_equals_brute_force_both_ways(spark):
    rows = random_rows()
    df = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "item_ord bigint, a double, b double, stationarity string")
    want = brute(rows)
    for limits in ({}, {"driver_states": 0}):  # few states, and a job per step
        got = rw.rank_walk(df, scores(), **limits, steps=60).collect()
        assert len(got) == len(rows) and all(abs(r.stationarity - want[r.item_ord] * len(rows)) < 1e-4 for r in got)
    for r in rw.rank_walk(df, scores()).collect():
        assert r["rank"] == 1 + sum(round(x * len(rows), 9) > round(want[r.item_ord] * len(rows), 9) for x in want)
    same = {r.item_ord: r.stationarity for r in rw.rank_walk(df, scores(), steps=6).collect()}
    by_tables = rw.rank_walk(df, scores(), steps=6, most_values=0).collect()  # the way for very many values
    assert len(by_tables) == len(rows) and all(abs(r.stationarity - same[r.item_ord]) < 1e-8 for r in by_tables)


def test_only_ranks_matter(spark):
    rows = random_rows(30, 7)
    one = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "item_ord bigint, a double, b double")
    scaled = one.withColumns({"a": F.exp("a") * 1e6, "b": F.col("b") / 1e9 - 5})
    assert {r.item_ord: r["rank"] for r in rw.rank_walk(one, scores()).collect()} == {r.item_ord: r["rank"] for r in rw.rank_walk(scaled, scores()).collect()}


def test_empty_and_scoreless_items(spark):
    df = spark.createDataFrame([], "item_ord bigint, a double, b double")
    assert rw.rank_walk(df, scores()).collect() == []
    alone = spark.createDataFrame([(1, None, None), (2, None, None), (3, 1.0, None)], "item_ord bigint, a double, b double")
    assert {r.item_ord: r["rank"] for r in rw.rank_walk(alone, scores()).collect()} == {3: 1, 1: 2, 2: 2}


def test_item_scores_drop_sentinels(spark):
    df = spark.createDataFrame([(-1.0, 2.0, 9), (float("nan"), None, 0), (99.0, 0.25, 3), (999.0, float("nan"), None)], "novelty_score double, solver_accuracy double, difficulty int")
    got = df.select(*[e.alias(n) for n, e in rw.item_scores().items()]).collect()
    assert [tuple(r) for r in got] == [(None, None, None), (None, None, None), (99.0, -0.25, 3.0), (None, None, None)]


def test_swap_repair_reaches_what_is_reachable():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 8)
        available = [rng.randint(0, 30) for _ in range(n)]
        wanted = [rng.randint(0, 15) for _ in range(n)]
        floors = [rng.randint(0, 3) for _ in range(n)]
        size = min(sum(wanted), sum(available))
        floors = sp.held_floors(floors, available, size)
        start = sp.start_sample(available, floors, size, rng)
        done = sp.swap_repair(start, wanted, floors, available)
        assert sum(start) == sum(done) and all(0 <= d <= a for d, a in zip(done, available))
        deviation = lambda x: sum(abs(p - w) for p, w in zip(x, wanted))
        assert deviation(done) <= deviation(start)
        for i in range(n):  # no single exchange improves
            for j in range(n):
                if i != j and done[i] > min(floors[i], available[i]) and done[j] < available[j]:
                    moved = list(done)
                    moved[i] -= 1
                    moved[j] += 1
                    assert deviation(moved) >= deviation(done)


def test_floors_beyond_the_sample_are_shared_out():
    assert sp.held_floors([30, 30], [50, 50], 20) == [10, 10] and sp.held_floors([30, 3, 9], [50, 2, 50], 10) == [7, 1, 2]
    rng = random.Random(2)
    for _ in range(300):
        n = rng.randint(1, 8)
        available, floors = [rng.randint(0, 30) for _ in range(n)], [rng.randint(0, 40) for _ in range(n)]
        wanted, size = [rng.randint(0, 15) for _ in range(n)], rng.randint(0, 60)
        done = sp.plan_rows(available, wanted, floors, size, rng)
        assert sum(done) == min(size, sum(available)) and all(0 <= d <= a for d, a in zip(done, available))
        held = sp.held_floors(floors, available, size)
        assert all(d >= h for d, h in zip(done, held)) and (sum(held) == size or held == [min(f, a) for f, a in zip(floors, available)])


def test_plan_reports_what_is_short(spark):
    df = items(spark, [(i, "a", "b" if i < 50 else "c", 1, 0) for i in range(100)])
    targets = spark.createDataFrame([("a", "b", 1, 5000, 30), ("a", "c", 1, 5000, 30)], "question_type string, subtype string, difficulty int, target_bp int, min_rows int")
    plan = sp.sample_plan(df, targets).collect()
    assert [(r.planned, r.met, r.short) for r in plan] == [(10, False, "size")] * 2
    assert sp.unmet_cells(df, targets).collect() == [] and sp.draw_sample(df, targets).count() == 20
    more = targets.union(spark.createDataFrame([("a", "d", 1, 0, 1)], targets.schema))
    assert [tuple(r) for r in sp.unmet_cells(df, more).collect()] == [("a", "d", 1)]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_ord bigint, question_type string, subtype string, difficulty int, planned int")


def test_cells_and_sample(spark):
    rows = [(i, " Text-Completion", "one  blank", 1 + i % 2, 0) for i in range(400)] + [(1000 + i, "text_completion", "TWO-BLANK", 1, 0) for i in range(5)] + [(2000, None, None, None, 0)]
    targets = spark.createDataFrame([("text_completion", "one_blank", 1, 5000, 2), ("text_completion", "one_blank", 2, 2500, 2), ("text_completion", "two_blank", 1, 2400, 3), ("none", "none", 3, 100, 1)], "question_type string, subtype string, difficulty int, target_bp int, min_rows int")
    df = items(spark, rows)
    plan = {(r.subtype, r.difficulty): r for r in sp.sample_plan(df, targets).collect()}
    assert sum(r.planned for r in plan.values()) == 406 // 5
    assert plan[("two_blank", 1)].available == 5 == plan[("two_blank", 1)].planned and not plan[("two_blank", 1)].met
    assert sorted(map(tuple, sp.unmet_cells(df, targets).collect())) == [("none", "none", 3), ("text_completion", "two_blank", 1)]
    drawn = sp.draw_sample(df, targets).collect()
    assert len({r.item_ord for r in drawn}) == len(drawn)
    assert Counter((r.subtype, r.difficulty) for r in drawn) == {k: r.planned for k, r in plan.items() if r.planned}
    assert {r.item_ord for r in drawn} != {r.item_ord for r in sp.draw_sample(df, targets, seed=12).collect()}


def test_large_cells_are_drawn_by_parts(spark, monkeypatch):
    monkeypatch.setattr(sp, "ROWS_A_PART", 7)
    df = items(spark, [(i, "a", "b", 1, 0) for i in range(1000)])
    targets = spark.createDataFrame([("a", "b", 1, 10000, 1)], "question_type string, subtype string, difficulty int, target_bp int, min_rows int")
    drawn = [r.item_ord for r in sp.draw_sample(df, targets).collect()]
    assert len(drawn) == len(set(drawn)) == 200


def test_empty_tables(spark):
    none = items(spark, [])
    targets = spark.createDataFrame([("a", "b", 1, 10000, 0), ("a", "c", 1, 0, 1)], "question_type string, subtype string, difficulty int, target_bp int, min_rows int")
    assert sorted(map(tuple, sp.unmet_cells(none, targets).collect())) == [("a", "c", 1)]
    assert sp.draw_sample(none, targets).collect() == [] and sp.unmet_cells(none, targets.limit(0)).collect() == []
