import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from examsift.llm import mixing, tokenizing
from examsift.llm.tokenizing import PieceEncoder, default_vocabulary

ODD = ["", " ", "a", "a   b", "a\n  b c", "\n \n x", "x\t y  ", "a 　 b", "\x1c x \x1c y", "<|endoftext|> is text", "café café 😀🏽 日本語", "don't we'll\r\nstop"]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(default_vocabulary())


def whole(encoder, texts):
    return [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def by_piece(encoder, texts):
    return [[int.from_bytes(b[i : i + 4], "little") for i in range(0, len(b), 4)] for b in encoder.ids(texts)]


def test_pieces_equal_whole_texts(encoder):
    assert by_piece(encoder, ODD) == whole(encoder, ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\r 　ab'1_.<|é日😀́", max_size=40), max_size=5))
def test_pieces_equal_whole_texts_at_random(encoder, texts):
    assert by_piece(encoder, texts) == whole(encoder, texts)


def test_memory_is_emptied_without_changing_results():
    small = PieceEncoder(default_vocabulary(), kept=3)
    for _ in range(3):
        assert by_piece(small, ODD) == whole(small, ODD)


def test_ids_counts_offsets_and_round_trip(spark, encoder):
    rows = [(i, t) for i, t in enumerate([*ODD, None, "word " * 20_000])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = df.select("doc_id", "text", tokenizing.token_ids(F.col("text")).alias("ids"), tokenizing.token_count(F.col("text")).alias("n"), tokenizing.token_offsets(F.col("text")).alias("o"))
    got = got.withColumn("back", tokenizing.decoded(F.col("ids"))).collect()
    for r in got:
        assert r.ids == whole(encoder, [r.text or ""])[0] and r.n == len(r.ids)
        assert r.back == (r.text or "")
        assert [x.id for x in r.o] == r.ids and all(0 <= x.start <= x.end <= len(r.text or "") for x in r.o)
    assert [r.ids for r in got if not r.text] == [[], []]


def test_unknown_ids_and_null_ids(spark):
    df = spark.createDataFrame([([72, 10_000_000],), ([],), (None,)], "ids array<int>")
    assert [r[0] for r in df.select(tokenizing.decoded(F.col("ids"))).collect()] == ["i", "", None]


def test_encoding_replaces_a_column_of_that_name(spark):
    df = spark.createDataFrame([("a", "kept", 1)], "text string, ids string, n int")
    assert tokenizing.encode_corpus(df).collect()[0].asDict() == {"text": "a", "ids": [64], "n": 1}


def test_mixture_follows_rates(spark):
    words = [(i, "alpha beta gamma delta", "big") for i in range(2000)] + [(5000 + i, "alpha beta", "small") for i in range(20)] + [(9000, None, "big"), (9001, "x y z", None)]
    docs = spark.createDataFrame(words, "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    rates = {r.source: r for r in mixing.source_rates(mixing.document_sizes(docs), targets).collect()}
    assert rates["big"].met and not rates["small"].met and not rates["none"].met
    assert rates["small"].rate == 3.0 and rates["none"].rate == 0.0
    out = mixing.mixture(docs, targets).collect()
    assert sorted(r.copy for r in out if r.source == "small") == [1] * 20 + [2] * 20 + [3] * 20
    big = [r for r in out if r.source == "big"]
    assert all(r.copy == 1 for r in big) and abs(len(big) - 2000 * rates["big"].rate) < 80
    assert sorted(map(tuple, out)) == sorted(map(tuple, mixing.mixture(docs.repartition(3), targets).collect()))
    shares = {r.source: r for r in mixing.shares_reached(docs, targets).collect()}
    assert shares["none"].actual_share == 0 and abs(sum(r.actual_share for r in shares.values()) - 1) < 1e-9
    assert {r.source for r in mixing.unmet_sources(docs, targets).collect()} == {"small", "none"}


def test_mixture_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), (None, None, None)], "source string, target_share double, max_repeats int")
    assert mixing.mixture(docs, targets).collect() == []
    assert mixing.unmet_sources(docs, targets).collect() == []
    assert mixing.unmet_sources(docs, targets.limit(0)).collect() == []
