import random
import re

import numpy as np
from pyspark.sql import functions as F

from examsift.llm import copies, near_duplicates as nd

WORDS = [f"w{i}" for i in range(400)]


def grams(text, n):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, percent):
    sets = {i: grams(t, n) for i, t in rows}
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    base = [" ".join(rng.choices(WORDS, k=rng.randint(30, 90))) for _ in range(n)]
    rows = list(base)
    for t in base:
        rows += [edited(t, rng, k) for k in (1, 3, 6)] + ([t.upper() + " !"] if rng.random() < 0.4 else [])
    return [(i, t) for i, t in enumerate(rows)]


def test_similar_records_equal_brute_force(spark):
    rows = corpus() + [(9001, None), (9002, ""), (9003, "two words"), (9004, "Two, words"), (9005, "x " * 5000), (9006, "x " * 4999)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = [tuple(r) for r in nd.similar_records(df, 3, 60).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows, 3, 60) | {(9003, 9004)}  # the same two words are copies


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    text = " ".join(rng.choices(WORDS, k=40))
    chain = [" ".join(f"c{i}" for i in range(4 * k, 4 * k + 30)) for k in range(12)]  # each like the next only
    rows = corpus(4, 20) + [(1000 + i, text + " ." * i) for i in range(10)] + [(1100, edited(text, rng, 1)), (1200, None), (1201, "one")]
    rows += [(1300 + 7 * k % 12, t) for k, t in enumerate(chain)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    pairs = brute(rows, 3, 60)
    group = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in pairs:
            group[a] = group[b] = min(group[a], group[b])
    for hot in (20_000, 0):  # with and without the salted way for hot keys
        got = {r.id: r for r in nd.similar_groups(df, 3, 60, hot_rows=hot).collect()}
        assert {i: r.group for i, r in got.items()} == group
        assert {i: r.links for i, r in got.items()} == {i: sum(i in p for p in pairs) for i, _ in rows}
        assert got[1005]["class"] == 1000 and got[1100]["class"] == 1100
        assert {tuple(r) for r in nd.similar_records(df, 3, 60, hot_rows=hot).collect()} == pairs
    assert len({group[1300 + k] for k in range(12)}) == 1


def test_every_pair_of_large_classes_is_listed(spark, monkeypatch):
    rng = random.Random(6)
    text = " ".join(rng.choices(WORDS, k=40))
    near = edited(text, rng, 1)
    rows = [(i, text + " ." * i) for i in range(40)] + [(100 + i, near + " !" * i) for i in range(34)] + [(200, edited(text, rng, 1))]
    df = spark.createDataFrame(rows, "id bigint, text string")
    for block in (nd.COPIES_IN_BLOCK, 3):
        monkeypatch.setattr(nd, "COPIES_IN_BLOCK", block)
        got = [tuple(r) for r in nd.similar_records(df, 3, 60).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, 3, 60)


def test_hot_buckets_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "HOT_BUCKET", 2)
    rows = corpus(2, 25) + [(5000 + i, " ".join(WORDS[:60] + WORDS[100 + i : 110 + i])) for i in range(30)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    assert {tuple(r) for r in nd.similar_records(df, 3, 60).collect()} == brute(rows, 3, 60)


def test_five_words_and_four_fifths_by_default(spark):
    rows = corpus(3, 20)
    df = spark.createDataFrame(rows, "id bigint, text string")
    assert {(r.a, r.b) for r in nd.similar_records(df).collect()} == brute(rows, 5, 80)


def test_dart_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, 60, dtype=np.uint64)
    b = np.concatenate([a[:40], rng.integers(0, 2**63, 20, dtype=np.uint64)])
    darts = nd.DartMinHash(2048)
    assert abs((darts.signature(a) == darts.signature(b)).mean() - 40 / 80) < 0.05
    weights = rng.uniform(0.2, 4.0, 60)
    other = weights.copy()
    other[:30] /= 2
    expected = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
    assert abs((darts.signature(a, weights) == darts.signature(a, other)).mean() - expected) < 0.05
    one = nd.DartMinHash(64).signature(a[:1])
    assert (one != np.iinfo(np.uint64).max).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    assert nd.similar_records(df).collect() == [] and nd.similar_groups(df).collect() == []
    items = spark.createDataFrame([], "item_ord bigint, stem string, answer_groups array<struct<choices:array<struct<label:string,text:string>>>>, stimulus string, explanation string")
    assert copies.hidden_copies(items).collect() == [] and copies.collapsed_items(items).collect() == []
    assert nd.similar_items(items).collect() == []


ITEM = "item_ord bigint, stem string, answer_groups array<struct<choices:array<struct<label:string,text:string>>>>, _form string, keep string"


def choice_groups(*groups):
    return [{"choices": [{"label": "A", "text": t} for t in g]} for g in groups]


def test_hidden_copies_ignore_form_order_and_groups(spark):
    rows = [
        (5, "The  Stem!", choice_groups(["one", "Two"], ["three"]), "", ""),
        (2, "the stem", choice_groups(["THREE."], ["two", "o-n-e"]), "", ""),
        (7, "THE STEM", choice_groups(["three", "two", "one"]), "", ""),
        (3, "the stem", choice_groups(["three", "two", "two", "one"]), "", ""),  # another multiset
        (1, None, None, "", ""),
        (4, "", [], "", ""),
        (8, "", [{"choices": None}], "", ""),
        (9, "", choice_groups([None]), "", ""),  # an empty choice text is a choice
        (10, "", choice_groups(["!"]), "", ""),
        (None, "the stem", choice_groups(["one", "two", "three"]), "", ""),
        (2, "the stem", choice_groups(["THREE."], ["two", "o-n-e"]), "", ""),  # a repeated row
    ]
    df = spark.createDataFrame(rows, ITEM)
    for hot in (20_000, 0):
        assert sorted(map(tuple, copies.hidden_copies(df, hot).collect())) == [(1, 4), (1, 8), (2, 5), (2, 7), (9, 10)]
        assert sorted(map(tuple, copies.collapsed_items(df, hot).collect())) == [(1, 3), (2, 5), (3, 1), (9, 2)]


def test_a_third_of_all_rows_in_one_group(spark):
    rows = spark.range(3000).select(F.col("id").alias("item_ord"), F.when(F.col("id") % 3 == 0, "hot stem").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("stem"), F.lit(None).cast("array<struct<choices:array<struct<label:string,text:string>>>>").alias("answer_groups"))
    got = copies.hidden_copies(rows, 100)
    assert got.count() == 999 and got.select("keep_ord").distinct().collect()[0][0] == 0
