import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from examsift.llm import repetition as rp
from examsift.llm import truncation as tr


@pytest.mark.parametrize(
    ("text", "kind", "marked"),
    [
        ('{"a": [1, 2]}', "closed", False),
        ('```json\n{"a": "x"}\n```', "closed", False),
        ('Here it is.\n{"a": "x"}\nAll done.', "sentence", False),
        ('Here it is.\n{"a": "x"}\nAll do', "word", False),
        ('{"a": "cut in the mid', "value", False),
        ('{"a": "cut \\" in", "b": [1, {"c": 2}', "value", False),
        ('{"a": "cut in the mi…', "value", True),
        ('{"a": "cut in the mi [...]', "value", True),
        ('```json\n{"a": [1,\n```', "value", False),
        ("A whole sentence.", "sentence", False),
        ("A whole sentence with [blank_1] in it.", "sentence", False),
        ("It said so...", "trailing", False),
        ("A broken sent", "word", False),
        ("A broken sent …", "word", True),
        ("B", "label", False),
        ("So it is. Final answer: A, C", "label", False),
        ("{'a': 'b'}", "closed", False),
        ("", "empty", False),
        ("  \n", "empty", False),
        ("[", "value", False),
    ],
)
def test_endings(text, kind, marked):
    assert tr.ending(text)[:2] == (kind, marked)


@pytest.mark.parametrize(
    ("text", "kind", "marked", "behind"),
    [
        ('{"items": [{"explanation": "A is right. Nothing in Ordraenmoor ventu"}]}', "string", False, '"}]}'),
        ('```json\n[{"explanation": "Tempting as it is, they test instead of Briwick"}]\n```', "string", False, '"}]\n```'),
        ('{"explanation": "Because Orsimith to"}', "string", False, '"}'),
        ('{"explanation": "A is right: anthems guided them, whereas eng…"\n }\n```', "string", True, '…"\n }\n```'),
        ('{"explanation": "A is right: anthems guided them, whereas eng"} [...]', "string", False, '"} [...]'),
        ('{"explanation": "A is right: anthems guided them, whereas eng"}…\n```', "string", False, '"}…\n```'),
        ('{"explanation": "He said \\"no\\" to all of the"}', "string", False, '"}'),
        ('{"passages": [{"text": "One whole sentence. And then a broken on"}]}', "string", False, '"}]}'),
        ('{"explanation": "It says so in the text."}', "closed", False, ""),
        ('{"explanation": "He said \\"no.\\""}', "closed", False, ""),
        ('{"rationale": "So the answer is: B"}', "closed", False, ""),
        ('{"explanation": "obvious"}', "closed", False, ""),
        ('{"choices": [{"label": "A", "text": "a choice of words that is no sentence"}]}', "closed", False, ""),
        ('{"answers": [{"blank": 1, "labels": ["B", "D"]}]}', "closed", False, ""),
    ],
)
def test_closers_put_behind_a_cut(text, kind, marked, behind):
    assert tr.ending(text) == (kind, marked, len(text) - len(behind))


def test_closed_values_with_a_broken_string_are_found_and_censored(spark):
    rng = random.Random(7)
    rows, want = [], set()
    for i in range(600):
        text = '{"explanation": "' + " ".join(rng.choice(["able", "birds", "carry", "dusty", "eggs"]) for _ in range(rng.randint(10, 90))) + '."}'
        if len(text) > 302:
            text = text[:300] + '"}'
            if text[299] != ".":
                want.add(i)
        rows.append(("t", i, "m", text))
    df = spark.createDataFrame(rows, "tbl string, row_key bigint, source string, text string")
    assert {r.row_key for r in tr.truncated_rows(df).collect()} == want and len(want) > 100
    assert [r.limits for r in tr.truncation_rates(df).collect()] == [[300]]


def test_three_dots_at_a_limit_are_cuts(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for i in range(900):
        text = "".join(rng.choice("abcdefgh") if k % 7 else " " for k in range(1, rng.randint(60, 700))) + "."
        if len(text) > 300:
            text = text[:300] + "..."
            want.add(i)
        rows.append(("t", i, "dots", text))
    df = spark.createDataFrame(rows + [("t", 5000, "dots", "It goes on and on...")], "tbl string, row_key bigint, source string, text string")
    assert {r.row_key for r in tr.truncated_rows(df).collect()} == want and len(want) > 100
    assert [r.limits for r in tr.truncation_rates(df).collect()] == [[300]]


def test_censored_fit_recovers_the_distribution():
    rng = np.random.default_rng(1)
    lengths = np.exp(rng.normal(6.5, 0.6, 20_000))
    limit = 900
    censored = lengths > limit
    mu, sigma = tr.fit_censored(np.minimum(lengths, limit), np.ones(len(lengths)), censored)
    assert abs(mu - 6.5) < 0.03 and abs(sigma - 0.6) < 0.03


def test_truncated_rows_by_source(spark):
    rng = random.Random(3)
    rows, want = [], set()
    for i in range(2000):
        text = " ".join(rng.choice(["able", "birds", "carry", "dusty", "eggs"]) for _ in range(rng.randint(10, 120))) + "."
        if i % 2 and len(text) > 300:
            text = text[:300] + ("…" if i % 4 == 1 else "")
        if len(text) >= 300 and i % 2:
            want.add(i) if not text.rstrip("…").endswith(".") else None
        rows.append(("t", i, "limited" if i % 2 else "free", text))
    rows += [("t", 5000, "limited", None), ("t", 5001, None, ""), ("t", 5002, "free", "stops in mid sen"), ("t", 5003, None, "Fine.")]
    df = spark.createDataFrame(rows, "tbl string, row_key bigint, source string, text string")
    assert {r.row_key for r in tr.truncated_rows(df).collect()} == want | {5002}
    rates = {r.source: r for r in tr.truncation_rates(df).collect()}
    assert rates["limited"].limits == [300] and rates["free"].limits == []
    assert rates["limited"].truncated == len(want) and rates["free"].truncated == 1 and rates[None].texts == 2


def prose(rng, least, most):
    return " ".join(rng.choice(["able", "birds", "carry", "dusty", "eggs"]) for _ in range(rng.randint(least, most)))


@pytest.mark.parametrize("n", [500, 20_000])
def test_one_cut_among_many_whole_texts_is_found(spark, n):
    rng = random.Random(4)
    rows = [("t", i, "clean", prose(rng, 8, 60) + ".") for i in range(n)] + [("t", -1, "clean", "The text stops in the middle of the senten")]
    df = spark.createDataFrame(rows, "tbl string, row_key bigint, source string, text string").repartition(4)
    assert [r.row_key for r in tr.truncated_rows(df).collect()] == [-1]


def test_the_lengths_decide_where_a_source_writes_without_ends(spark):
    """Titles have no end of a sentence; of texts without one only those at the limit are cut."""
    rng = random.Random(9)
    rows, want = [], set()
    for i in range(1500):
        if i % 3 == 0:
            text = prose(rng, 5, 7)  # a title
        else:
            text = prose(rng, 20, 70) + "."
            if len(text) > 240:
                text = text[:240]
                want.add(i)
        rows.append(("t", i, "titles", text))
    df = spark.createDataFrame(rows, "tbl string, row_key bigint, source string, text string")
    assert {r.row_key for r in tr.truncated_rows(df).collect()} == want and len(want) > 100
    judged = tr.judge_endings(df)[0]
    assert {r.row_key for r in judged.filter("by_ending").collect()} != want
    rates = tr.truncation_rates(df).first()
    assert rates.limits == [240] and rates.by_length > 100 and rates.truncated == len(want)


def test_piled_lengths_beyond_the_single_ones_are_limits(spark):
    rng = random.Random(10)
    rows = []
    for i in range(400):
        text = prose(rng, 100, 2800) + "."
        limit = 9000 if i % 2 else 9001  # two limits in one bin
        rows.append(("t", i, "far", text[:limit] if len(text) > limit else text))
    df = spark.createDataFrame(rows, "tbl string, row_key bigint, source string, text string")
    assert tr.truncation_rates(df).first().limits == [9000, 9001] and tr.EXACT < 9000
    assert {r.row_key for r in tr.truncated_rows(df).collect()} == {i for _, i, _, t in rows if not t.endswith(".")}


@pytest.mark.parametrize(("text", "length"), [('{"a": "cut in…', 13), ('{"a": "cut in …', 14), ('{"a": "cut in [...]', 13), ('{"a": "cut in  [...]', 14), ('{"a": "cut in', 13)])
def test_length_without_the_mark(text, length):
    assert tr.ending(text)[2] == length


def test_no_texts(spark):
    df = spark.createDataFrame([], "tbl string, row_key bigint, source string, text string")
    assert tr.truncated_rows(df).collect() == [] and tr.truncation_rates(df).collect() == []


def brute(tokens, run=5):
    grams = [tuple(tokens[i : i + run]) for i in range(len(tokens) - run + 1)]
    return len({i + k for i, g in enumerate(grams) if g in grams[:i] for k in range(run)})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words_equal_brute_force(tokens):
    assert rp.repeated_words(tokens) == brute(tokens)
    if len(tokens) > 5:
        assert rp._covered_by_sorting(tokens, 5) == rp.covered_words(tokens)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "\n", " \n", "-\n"]), max_size=80))
def test_lines_share_out_what_repeats(parts):
    text = " ".join(parts)
    counts, kept = rp.judge_lines(text)
    tokens = rp.words(text)
    assert (counts["n_words"], counts["n_repeated"]) == (len(tokens), brute(tokens))
    assert counts["n_repeated"] <= counts["words_repeating"] <= counts["words_lost"] <= counts["n_words"]
    assert sum(len(rp.words(line)) for line in kept) == counts["n_words"] - counts["words_lost"]


def test_repetitive_documents(spark):
    line = "the quick brown fox jumps over"
    rows = [(1, f"{line} {line} {line}"), (2, line.upper() + "!! " + line), (3, "one two three four five"), (4, None), (5, ""), (6, " ".join(map(str, range(500)))), (7, "a " * 100_000), (8, "a b c d e a b c d e"), (8, "a b c d e a b c d e")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, n_words string")
    assert sorted(r.doc_id for r in rp.repetitive_documents(df).collect()) == [1, 2, 7, 8, 8]
    shares = {r.doc_id: r for r in rp.repeated_share(df).collect()}
    assert shares[4].repeated_share == 0.0 and shares[7].n_repeated == 99_999 and shares[8].n_repeated == 5
    assert rp.repetitive_documents(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("-----", "punctuation"), ("* * *", "punctuation"), ("___", "punctuation"), ("- 5 -", None),
        ("Home | About | Contact", "navigation"), ("Start > Guides > Verbs", "navigation"), ("Next", "navigation"), ("« Previous", "navigation"), ("Page 3 of 12", "navigation"),
        ("3 / 12", "navigation"), ("a | b", None), ("Next we turn to verbs.", None), ("|x| > 3 and so it follows that the left side is larger | than the right", None),
        ("<div><br/></div>", "boilerplate"), ("© 2019 Some House", "boilerplate"), ("All rights reserved.", "boilerplate"), ("Privacy Policy", "boilerplate"),
        ("Subscribe to our newsletter!", "boilerplate"), ("Lorem ipsum dolor sit amet", "boilerplate"), ("The privacy policy was written in haste.", None), ("<b>bold</b> word", None),
    ],
)
def test_line_rules(line, rule):
    counts, kept = rp.judge_lines(line)
    assert [n for n in rp.LINE_RULES if counts[f"by_{n}"]] == ([rule] if rule else []) and kept == ([] if rule else [line])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "\n", "\r", "\r\n", "\v", "\f", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u2028", "\u2029", "\t"]), max_size=12))
def test_lines_end_at_any_break(parts):
    text = "".join(parts)
    counts, kept = rp.judge_lines(text)
    assert kept == rp.BREAK.split(text) and counts["n_lines"] == sum(bool(x.strip()) for x in rp.BREAK.split(text))


def test_clean_lines(spark):
    again = "we keep the same five words here"
    rows = [(1, f"Keep this line.\n-----\nHome | About | Contact\n\n{again}\r\nAnother one.\n{again}"), (2, "***\n***\nshort"), (3, None), (4, "All rights reserved\n<p></p>"), (5, "---")]
    got = {r.doc_id: r for r in rp.clean_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert (got[1].n_lines, got[1].by_punctuation, got[1].by_navigation, got[1].by_repetition, got[1].words_lost) == (6, 1, 1, 1, 10) and got[1].rejected
    kept = {r.doc_id: r for r in rp.clean_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), most_lost_percent=60).collect()}
    assert kept[1].cleaned == f"Keep this line.\n\n{again}\nAnother one."
    assert got[2].by_punctuation == 2 and not got[2].rejected and got[2].cleaned == "short"
    assert got[3].n_lines == 0 and not got[3].rejected and got[3].cleaned == ""
    assert got[4].by_boilerplate == 2 and got[4].rejected and got[4].cleaned is None
    assert not got[5].rejected and got[5].cleaned == ""
