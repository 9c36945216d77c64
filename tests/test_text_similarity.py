import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from examsift.functions import text as X
from examsift.functions.constants import STOPWORDS
from examsift.operators import similarity as S


def one(spark, make, *values, kind="string"):
    """Result of a Column function for literal columns a, b, …"""
    names = "abcdef"[: len(values)]
    df = spark.createDataFrame([values], ", ".join(f"{n} {kind}" for n in names))
    return df.select(make(*[F.col(n) for n in names]).alias("x")).first().x


@pytest.mark.parametrize(
    ("make", "text", "want"),
    [
        (X.squeeze, " a \t\n b  ", "a b"),
        (X.squeeze, None, ""),
        (X.match_form, "The [Blank_1], 40% of  CAFÉ!", "the blank 40% of caf"),
        (X.tokens, "Don't stop-gap 1,200 and 40% or 15 percent B2", ["don't", "stop-gap", "1,200", "and", "40%", "or", "15 percent", "b", "2"]),
        (X.content_tokens, "'Tis the cats' paw, and the cats' paw of it", ["tis", "cats", "paw", "cats", "paw"]),
        (X.labeled_choices, "Body. Choices: A. first one; B. second,  C. third", ["first one", "second", "third"]),
        (X.labeled_choices, "No labels A.here", []),
        (X.labeled_choices, None, []),
        (X.structure_text, "Body text. CHOICES : A. x", "Body text."),
        (X.structure_text, "MyChoices: stay", "MyChoices: stay"),
        (X.abstract_structure, "He saw 12% of [blank_1], then left.", "W , W ."),
        (X.abstract_structure, "", ""),
        (X.distinctive_terms, "In 1912 Lady Marlow of Kent paid 40% to GRE. It Ran. Bob", ["1912", "40", "it ran", "lady marlow of kent"]),
        (X.distinctive_terms, "A. Verbal Some Question", ["verbal some question"]),
        (X.distinctive_terms, None, []),
    ],
)
def test_text_functions(spark, make, text, want):
    assert one(spark, make, text) == want


def test_ngrams(spark):
    words = ["a", "b", "c", "a", "b", "c"]
    got = one(spark, lambda w: X.ngrams(w, 3), words, kind="array<string>")
    assert sorted(g.split(X.GRAM) for g in got) == [["a", "b", "c"], ["b", "c", "a"], ["c", "a", "b"]]
    assert one(spark, lambda w: X.ngrams(w, 3), ["a"], kind="array<string>") == []
    assert one(spark, lambda w: X.ngrams(w, 3), None, kind="array<string>") == []


def test_set_measures(spark):
    a, b = ["x", "y", "y", "z"], ["y", "z", "w", "v", "u"]
    both = [one(spark, f, a, b, kind="array<string>") for f in (S.jaccard, S.containment, S.lexical_similarity)]
    assert both == pytest.approx([2 / 6, 2 / 3, 0.65 * 2 / 6 + 0.35 * 2 / 3])
    assert one(spark, S.jaccard, [], b, kind="array<string>") == 0.0
    assert one(spark, S.jaccard, b, a, kind="array<string>") == both[0]
    reuse = one(spark, S.entity_reuse, ["marlow", "1912"], ["1912", "kent"], kind="array<string>")
    assert (reuse.share, reuse.terms) == (0.5, ["1912"])


ITEM = "item_ord bigint, stem string, stimulus string, passage string, passages array<struct<label:string,text:string>>, answer_groups array<struct<blank:int,choices:array<struct<label:string,text:string>>,correct_labels:array<string>>>, note string"
SEED = "seed_id string, source_question string"


def groups(*texts):
    return [{"blank": None, "choices": [{"label": "ABCDE"[i], "text": t} for i, t in enumerate(texts)], "correct_labels": ["A"]}]


def score(spark, items, seeds, **more):
    features = S.item_features(spark.createDataFrame(items, ITEM), ["item_ord"])
    got = S.score_novelty(features, S.seed_features(spark.createDataFrame(seeds, SEED)), ["item_ord"], **more)
    return {r.item_ord: r for r in got.collect()}


BODY = "The harbour master of Port Ellen was so cautious that shipping clerks found every warning rather tedious."
SEEDS = [("s1", BODY + " Choices: A. imprudent B. lavish C. tedious"), ("s2", "Glaciers retreat whenever summers lengthen, and rivers swell. Choices: A. verdant B. solemn"), (None, "Unnamed seed about bees. Choices: A. honeyed")]


def test_identical_copied_reused_and_fresh_items(spark):
    items = [
        (1, BODY, None, None, None, groups("imprudent", "lavish", "tedious"), "n"),
        (2, "Comets return on schedule though almanacs doubt them.", None, None, None, groups("imprudent", "punctual"), "n"),
        (3, "Nothing here resembles anything else at all.", None, None, None, groups("orderly", "sparse"), "n"),
        (4, "Someone from Port Ellen wrote about quinces.", None, None, None, groups("orderly", "sparse"), "n"),
        (5, None, None, None, None, None, "n"),
    ]
    got = score(spark, items, SEEDS)
    assert got[1].novelty_score < 75 and got[1].max_similarity_source_id == "s1" and not got[1].novelty_pass
    assert got[2].copied_answer_choices == ["imprudent"] and not got[2].novelty_pass
    assert got[3].novelty_score >= 75 and got[3].novelty_pass and got[3].novelty_reasons == ["passes novelty gate"]
    assert got[4].reused_distinctive_terms == ["port ellen"] and not got[4].novelty_pass
    assert got[5].novelty_score == 100.0 and got[5].max_similarity_source_id == "source-1"  # all equal: the earliest
    assert all(0 <= r.novelty_score <= 100 for r in got.values())
    assert {i: tuple(r) for i, r in score(spark, items, SEEDS, at_once=1).items()} == {i: tuple(r) for i, r in got.items()}


def test_no_sources_and_no_items(spark):
    got = score(spark, [(1, "Stem.", None, None, None, None, "n")], [])
    assert got[1].novelty_score == 100.0 and got[1].max_similarity_source_id is None and got[1].novelty_pass
    assert got[1].novelty_components.structure_novelty == 100.0 and got[1].max_similarity_score == 0.0
    assert score(spark, [], SEEDS) == {}
    scored = S.score_novelty(S.item_features(spark.createDataFrame([], ITEM), ["item_ord"]), S.seed_features(spark.createDataFrame(SEEDS, SEED)), ["item_ord"])
    assert S.novelty_summary(scored).first().average_novelty_score is None


def test_pruning_finds_the_same_as_all_pairs():
    import pandas as pd

    rng = random.Random(1)
    words = [f"word{i}" for i in range(60)]
    sources, rows = [], []
    for i in range(40):
        w = rng.choices(words, k=12)
        sources.append({"source_id": f"s{i}", "ord": i, "tokens": list(dict.fromkeys(w)), "grams3": [" ".join(w[k : k + 3]) for k in range(10)], "grams4": [], "choices": rng.choices(["able", "abler", "sedulous", "sedulously"], k=3), "terms": rng.choices(["1912", "kent", "elm"], k=1), "structure": "".join(rng.choices(["W ", ", ", ". ", "é"], k=rng.randint(0, 60))).strip()})
    index = S.SourceIndex(pd.DataFrame(sources))
    for _ in range(60):
        s = rng.choice(sources)
        item = (s["tokens"][: rng.randint(0, 12)], s["grams3"][: rng.randint(0, 5)], [], rng.choices(["able", "sedulous", "x"], k=2), rng.choices(["1912", "oak"], k=rng.randint(0, 2)), "".join(rng.choices(["W ", ", ", ". "], k=rng.randint(0, 60))).strip())
        place, parts, _, _ = index.riskiest(*item)
        known = 0.35 * index.lexical(item[0]) + 0.2 * index.phrase([item[1], []])
        best = []
        for i, source in enumerate(sources):
            choice = sum(any(c == d or SequenceMatcher(None, c, d).ratio() >= 0.92 for d in source["choices"]) for c in item[3]) / 2
            entity = sum(t in source["terms"] for t in item[4]) / len(item[4]) if item[4] else 0
            ratio = SequenceMatcher(None, item[5], source["structure"]).ratio() if item[5] and source["structure"] else 0
            best.append((S.novelty_of(known[i] + 0.2 * choice + 0.15 * entity + 0.1 * ratio), i))
        assert min(best)[1] == place


def test_near_copies_of_choices():
    import pandas as pd

    index = S.SourceIndex(pd.DataFrame([{"source_id": "s", "ord": 1, "tokens": [], "grams3": [], "grams4": [], "choices": ["the long winding road home", "ephemeral"], "terms": [], "structure": ""}]))
    assert index.copies_of("the long winding road home now") == frozenset({0}) or SequenceMatcher(None, "the long winding road home now", "the long winding road home").ratio() < 0.92
    assert index.copies_of("home road winding long the") == frozenset({0})  # the same words
    assert index.copies_of("ephemera") == frozenset({0}) and index.copies_of("eternal") == frozenset()


def test_long_structures_keep_the_matchers_junk_rule():
    long = "W , W . " * 60
    import pandas as pd

    index = S.SourceIndex(pd.DataFrame([{"source_id": "s", "ord": 1, "tokens": [], "grams3": [], "grams4": [], "choices": [], "terms": [], "structure": long}]))
    assert index._structure_ratio(0, long[8:]) == SequenceMatcher(None, long[8:], long).ratio()


def test_stopwords_are_plain():
    assert len(STOPWORDS) == len(set(STOPWORDS)) and all(re.fullmatch("[a-z]+", w) for w in STOPWORDS)
