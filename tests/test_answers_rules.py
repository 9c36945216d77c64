import json

import pytest
from pyspark.sql import functions as F

from examsift.operators import answers, generation, judging, rules, sizing
from examsift.sources import jsonl

GROUPS = "array<struct<blank:int,choices:array<struct<label:string,text:string>>,correct_labels:array<string>>>"


def group(blank, correct, n=5):
    return {"blank": blank, "choices": [{"label": "ABCDEFG"[i], "text": f"choice {i}"} for i in range(n)], "correct_labels": correct}


def graded(spark, groups, raw):
    df = spark.createDataFrame([(groups, raw)], f"answer_groups {GROUPS}, raw_response string")
    return answers.grade_rows(df.withColumn("read", answers.read_response(F.col("raw_response")))).first()


TWO = [group(1, ["A"]), group(2, ["D"])]


@pytest.mark.parametrize(
    ("groups", "raw", "correct"),
    [
        (TWO, '{"answers":[{"blank":1,"labels":["A"]},{"blank":2,"labels":["D"]}]}', True),
        (TWO, '{"answers":[{"blank":2,"labels":["D"]},{"blank":"blank 1","labels":"a"}]}', True),
        (TWO, '{"blank_1": "A", "Blank 02": ["D"]}', True),
        (TWO, '{"blank_1": "A"}', False),
        (TWO, '{"answers":[{"blank":1,"labels":["A"]},{"blank":2,"labels":["D"]},{"blank":3,"labels":["C"]}]}', False),
        ([group(1, ["B", "E"], 6)], '{"labels": ["E", "B"]}', True),
        ([group(1, ["B", "E"], 6)], '{"labels": ["B"]}', False),
        ([group(None, ["A", "C"])], '{"answer": "A and C"}', False),  # "and" is no label, but the word A… below
        ([group(None, ["C"])], '```json\n{"answer": "C"}\n```', True),
        ([group(None, ["C"])], 'I think so: {"answers": ["C"]} is right', True),
        ([group(None, ["C"])], '{"answers": [{"blank_index": 7, "answer": {"label": "C"}}]}', True),
        ([group(None, ["C"])], "no JSON", False),
        ([group(None, ["C"])], "[1, 2]", False),
        ([group(None, ["C"])], None, False),
        ([], "{}", True),
        (None, '{"x": 1}', True),
        ([group(None, ["c"])], '{"answer": "c"}', True),
    ],
)
def test_grading(spark, groups, raw, correct):
    if raw == '{"answer": "A and C"}':
        correct = True  # A and C stand alone, "and" does not
    assert graded(spark, groups, raw).correct is correct


def test_graded_details(spark):
    r = graded(spark, TWO, '{"answers":[{"blank":2,"labels":["B"]}]}')
    assert r.missing_blanks == ["1"] and r.parse_error is None and [tuple(p) for p in r.predicted] == [("2", ["B"])]
    broken = graded(spark, TWO, "nothing")
    assert broken.parse_error and broken.predicted == [] and broken.missing_blanks is None and len(broken.expected) == 2


@pytest.mark.parametrize(("value", "want"), [("null", None), ('"None"', None), ("3", "3"), ('"Blank 07"', "7"), ('"Middle"', "middle"), ("true", "1"), ('""', None)])
def test_blank_names(value, want):
    assert answers.blank_name(json.loads(value)) == want


@pytest.mark.parametrize(
    ("value", "want"),
    [('"a, b"', ["A", "B"]), ('["B", ["A", "B"]]', ["A", "B"]), ('{"label": "D"}', ["D"]), ('[{"label": "C"}, "A"]', ["A", "C"]), ("5", []), ("null", []), ('"word"', []), ('"x\\nB"', ["B", "X"]),
     ('{"answer":{"labels":{"label":{"answer":"B"}}}}', ["B"]), ('{"labels": null, "label": "A"}', []), ('{"other": "A"}', [])],
)
def test_labels(value, want):
    assert answers.labels_in(json.loads(value)) == want


def test_labels_at_any_depth(spark):
    deep = '{"answer": ' + '{"labels": [' * 150 + '"c"' + "]}" * 150 + "}"
    assert graded(spark, [group(None, ["C"])], deep).correct is True
    assert graded(spark, [group(None, ["C"])], '{"answer":{"labels":{"label":{"answer":"C"}}}}').correct is True
    assert graded(spark, [group(None, ["C"])], "[" * 100_000).parse_error


def test_response_of_a_record(spark):
    rows = [('{"generation": "g", "answer": "a"}', "g"), ('{"response": null, "answer": "a"}', "None"), ('{"answer": {"label": "B"}}', '{"label":"B"}'), ("{}", "")]
    df = spark.createDataFrame(rows, "line string, want string").withColumn("got", answers.record_response(F.parse_json("line")))
    assert all(r.got == r.want for r in df.collect())


def items_and_responses(spark):
    items = spark.createDataFrame([(1, "x", TWO, "keep"), (2, None, [group(None, ["C"])], "keep"), (3, "x", [group(None, ["C"])], "keep"), (4, "lonely", TWO, "keep")], f"item_ord bigint, id string, answer_groups {GROUPS}, correct string")
    rows = [(1, "x", "m", '{"answer":"C"}', None, None), (2, "item-2", None, None, '{"answer":"C"}', None), (3, "unknown", "m", None, None, "C"), (4, "item-2", "m", None, None, '{"answer":"B"}'), (5, None, "m", None, None, None)]
    return items, spark.createDataFrame(rows, "resp_id bigint, item_id string, model string, generation string, response string, answer string")


def test_attempts_accuracy_and_summaries(spark, monkeypatch):
    items, responses = items_and_responses(spark)
    got = answers.attempts(items, responses)
    assert sorted((r.item_ord, r.resp_id, r.correct) for r in got.collect()) == [(1, 1, False), (2, 2, True), (2, 4, False), (3, 1, True)]
    monkeypatch.setattr(answers, "hot_keys", lambda *a: ["x", "item-2"])  # the salted way
    assert sorted(map(str, answers.attempts(items, responses).collect())) == sorted(map(str, got.collect()))
    monkeypatch.undo()
    per_item = answers.item_accuracy(items, got)
    assert {r.item_ord: r.solver_accuracy for r in per_item.collect()} == {1: 0.0, 2: 0.5, 3: 1.0, 4: None}
    total = answers.solver_summary(per_item).first()
    assert (total.total_items, total.total_solver_attempts, total.overall_accuracy, total.average_item_accuracy) == (4, 4, 0.5, 0.5)
    assert {r.model: (r.total, r.correct) for r in answers.model_totals(got).collect()} == {"m": (3, 1), "None": (1, 1)}
    assert sorted(r.resp_id for r in answers.unknown_responses(items, responses).collect()) == [3, 5]
    monkeypatch.setattr(sizing, "AS_LITERALS", 1)  # and with the hot ids joined
    monkeypatch.setattr(answers, "hot_keys", lambda *a: ["x", "item-2"])
    assert sorted(map(str, answers.attempts(items, responses).collect())) == sorted(map(str, got.collect()))
    monkeypatch.undo()
    attached = {r.item_ord: r for r in answers.attach_results(items, got).collect()}
    assert [x.model for x in attached[2].solver_results] == [None, "m"] and attached[4].solver_results == [] and attached[4].solver_accuracy is None
    none = answers.attempts(items, responses.limit(0))
    assert none.collect() == [] and answers.solver_summary(answers.item_accuracy(items.limit(0), none)).first().overall_accuracy is None


def test_no_attempt_is_lost(spark):
    items, responses = items_and_responses(spark)
    many = spark.range(10, 10_011).selectExpr("id resp_id", "'lonely' item_id", "'m' model", "'{}' generation", "CAST(null AS string) response", "CAST(null AS string) answer")
    graded = answers.attempts(items, responses.unionByName(many)).cache()
    assert {r.item_ord: r.n_attempts for r in answers.attach_results(items, graded).collect()} == {1: 1, 2: 2, 3: 1, 4: 10_001}
    for most in (1_000, 10_001):
        chunks = answers.result_chunks(graded, most).selectExpr("item_ord", "chunk", "size(solver_results) n").collect()
        assert sum(r.n for r in chunks) == graded.count() and max(r.chunk for r in chunks) == (10 if most == 1_000 else 0)
        assert all(r.n < 1.3 * most for r in chunks)
        rows = answers.attach_results(items, graded, most).collect()
        assert all(r.solver_results is not None and r.n_attempts >= len(r.solver_results) for r in rows)
        assert (len(next(r for r in rows if r.item_ord == 4).solver_results) == 10_001) == (most == 10_001)


GOOD = {
    "text_completion": {"id": "a", "question_type": "text_completion", "stem": "s", "explanation": "e", "answer_groups": [group(1, ["A"], 3)]},
    "sentence_equivalence": {"id": "a", "question_type": "sentence_equivalence", "stem": "s", "explanation": "e", "answer_groups": [group(1, ["A", "B"], 6)]},
    "logical_reasoning": {"id": "a", "question_type": "logical_reasoning", "subtype": "flaw", "stimulus": "t", "stem": "s", "explanation": "e", "answer_groups": [group(None, ["A"])]},
    "single": {"id": "a", "question_type": "reading_comprehension", "subtype": "single_passage", "passage_set_id": "p", "passages": ["text"], "stem": "s", "explanation": "e", "answer_groups": [group(None, ["A"])]},
    "comparative": {"id": "a", "question_type": "reading_comprehension", "subtype": "comparative_passages", "passage_set_id": "p", "passages": [{"label": "A", "text": "x"}, {"label": "B", "text": "y"}], "stem": "s", "explanation": "e", "answer_groups": [group(None, ["A"])]},
    "plain reading": {"id": "a", "question_type": "reading_comprehension", "subtype": "select_one", "passage": "text", "stem": "s", "explanation": "e", "answer_groups": [group(None, ["A", "B"])]},
}


def change(base, **more):
    out = json.loads(json.dumps(GOOD[base]))
    for k, v in more.items():
        if v is ...:
            del out[k]
        else:
            out[k] = v
    return out


def with_group(base, **more):
    out = change(base)
    out["answer_groups"][0] |= more
    return out


CASES = [(GOOD[k], []) for k in GOOD] + [
    (change("text_completion", id=...), ["V1"]),
    (change("text_completion", id=None), []),
    (change("text_completion", question_type="essay"), ["V2"]),
    (change("text_completion", question_type=["essay"]), ["V2"]),
    (change("text_completion", stem=" "), ["V3"]),
    (change("text_completion", stem=5), ["V3"]),
    (change("text_completion", explanation=None), ["V4"]),
    (change("text_completion", answer_groups=[]), ["V5"]),
    (change("text_completion", answer_groups="x"), ["V5"]),
    (change("text_completion", answer_groups=["x"]), ["V6"]),
    (with_group("text_completion", choices=[]), ["V10", "V7"]),
    (with_group("text_completion", choices=None), ["V10", "V7", "internal"]),
    (with_group("text_completion", choices=[{"label": "A", "text": "x"}, {"label": "A", "text": "y"}]), ["V8"]),
    (with_group("text_completion", correct_labels=[]), ["V15", "V9"]),
    (with_group("text_completion", correct_labels=["Z"]), ["V10"]),
    (with_group("text_completion", choices=[{"label": "A", "text": "x"}, "B"]), ["V11"]),
    (with_group("text_completion", choices=[{"label": "A", "text": "x"}, {"label": " ", "text": "y"}]), ["V12"]),
    (with_group("text_completion", choices=[{"label": "A", "text": "x"}, {"label": "B", "text": None}]), ["V13"]),
    (change("text_completion", answer_groups=[group(i, ["A"], 3) for i in range(4)]), ["V14"]),
    (with_group("text_completion", correct_labels=["A", "B"]), ["V15"]),
    (change("sentence_equivalence", answer_groups=[group(1, ["A", "B"], 6)] * 2), ["V16"]),
    (change("sentence_equivalence", answer_groups=[group(1, ["A", "B"], 5)]), ["V17"]),
    (change("sentence_equivalence", answer_groups=[group(1, ["A"], 6)]), ["V18"]),
    (change("single", subtype="select_one"), ["V20"]),
    (change("single", passage_set_id=None), ["V21"]),
    (change("single", passages=[]), ["V24", "V34"]),
    (change("single", passages=None), ["V34"]),
    (change("single", passages=[" "]), ["V35"]),
    (change("single", passages=[7]), ["V36"]),
    (change("single", passages=[{"label": "A"}]), ["V37"]),
    (change("single", passages=[{"label": "", "text": "x"}]), ["V38"]),
    (change("comparative", passages=[{"label": "A", "text": "x"}, {"label": "A", "text": "y"}]), ["V39"]),
    (change("comparative", passages=["x"]), ["V24"]),
    (change("plain reading", passage=" "), ["V25"]),
    (change("logical_reasoning", subtype="x"), ["V26"]),
    (change("logical_reasoning", stimulus=...), ["V27"]),
    (change("logical_reasoning", answer_groups=[group(None, ["A"])] * 2), ["V29"]),
    (change("logical_reasoning", answer_groups=["x"]), ["V30", "V6"]),
    (change("logical_reasoning", answer_groups=[group(1, ["A"])]), ["V31"]),
    (change("logical_reasoning", answer_groups=[group(None, ["A"], 4)]), ["V32"]),
    (change("logical_reasoning", answer_groups=[group(None, ["A", "B"])]), ["V33"]),
]


def test_every_rule(spark):
    lines = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(CASES)], "line_no bigint, line string")
    got = {r.line_no: sorted({e.rule for e in r.rule_errors}) for r in rules.with_errors(jsonl.parse_lines(lines)).collect()}
    assert got == {i: sorted(want) for i, (_, want) in enumerate(CASES)}
    checked = rules.with_errors(jsonl.parse_lines(lines))
    texts = checked.select("line_no", rules.error_texts(F.col("rule_errors"), F.col("line_no")).alias("t")).collect()
    said = {r.line_no: r.t for r in texts}
    assert said[[i for i, (_, w) in enumerate(CASES) if w == ["V10"]][0]] == [f"line {[i for i, (_, w) in enumerate(CASES) if w == ['V10']][0]}: correct labels not found in choices: ['Z']"]
    totals = rules.validation_totals(checked).first()
    assert totals.records == len(CASES) and totals.invalid_records == sum(bool(w) for _, w in CASES)
    assert sum(r.errors for r in rules.rule_counts(checked).collect()) == totals.errors


def test_reading_lines(spark, tmp_path):
    for n, text in enumerate(['\n{"a": 1}\n \n[1]\n{broken\n', '{"b": 2}']):
        (tmp_path / f"{n}.jsonl").write_text(text)
    paths = [str(tmp_path / "1.jsonl"), str(tmp_path / "0.jsonl")]
    lines = jsonl.read_lines(spark, paths)
    got = sorted((r.file_idx, r.line_no, r.line_error) for r in jsonl.parse_lines(lines).collect())
    assert got == [(0, 1, None), (1, 2, None), (1, 4, "row must be a JSON object"), (1, 5, "invalid JSON")]
    with pytest.raises(Exception, match="1:4: row must be a JSON object|1:5: invalid JSON"):
        jsonl.parse_lines(lines, strict=True).select("record").collect()
    assert jsonl.read_lines(spark, []).collect() == []


def test_writing_lines(spark, tmp_path):
    df = spark.createDataFrame([(2, None, "é"), (1, 0.5, "x")], "b bigint, a double, c string")
    jsonl.write_lines(df, str(tmp_path / "out"), ["b"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines() == ['{"a":0.5,"b":1,"c":"x"}', '{"a":null,"b":2,"c":"é"}']
    summary = jsonl.write_summary(df.agg(F.count(F.lit(1)).alias("n")), str(tmp_path / "s" / "summary.json"), reasons=spark.createDataFrame([("r", 2)], "k string, n bigint"))
    assert summary == json.loads((tmp_path / "s" / "summary.json").read_text()) == {"n": 2, "reasons": {"r": 2}}


def test_generations(spark):
    rows = [
        (1, "s", "t", "m", '{"items": [{"stem": "a"}, {"id": null, "stem": "b", "extra": {"k": 1}}]}'),
        (2, None, "t", "m", '```json\n[{"id": "own"}]\n```'),
        (3, "s", "t", "m", 'Sure:\n{"items": [{"stem": "c"}]}\nDone.'),
        (4, "s", "t", "m", '{"items": [{"stem": "c"}, 5]}'),
        (5, "s", "t", "m", "no"),
        (6, "s", "t", None, None),
        (7, "s", "t", "m", '{"other": []}'),
        (8, "s", "t", "m", "[]"),
    ]
    raw = spark.createDataFrame(rows, "gen_id bigint, seed_id string, question_type string, model_name string, generation string")
    parsed = generation.parse_generations(raw)
    items = {(r.gen_id, r.pos): json.loads(r.j) for r in generation.explode_items(parsed, "v1").select("gen_id", "pos", F.to_json("item").alias("j")).collect()}
    assert set(items) == {(1, 0), (1, 1), (2, 0), (3, 0)}
    assert items[(1, 0)] == {"stem": "a", "id": "synthetic-s-001", "source_seed_id": "s", "generation_model": "m", "prompt_version": "v1"}
    assert items[(1, 1)]["id"] is None and items[(1, 1)]["extra"] == {"k": 1}
    assert items[(2, 0)]["id"] == "own" and items[(2, 0)]["source_seed_id"] == "seed-2"
    assert sorted(r.error for r in generation.failed_generations(parsed).collect()) == sorted(["each generated item must be a JSON object", "generation holds no JSON", "generation holds no JSON", "generation must be a JSON object with an 'items' list"])
    requests = spark.createDataFrame([(1, "a", "s"), (2, "b", "s")], "item_id bigint, instruction string, system_prompt string")
    assert {r.generation for r in generation.generate(requests, lambda texts, systems, p: [t * p["n"] for t in texts], {"n": 2}, ["item_id"]).collect()} == {"aa", "bb"}

    def fails(*_):
        raise RuntimeError

    assert {r.generation for r in generation.generate(requests, fails, {}, ["item_id"]).collect()} == {None}
    assert generation.model_list(["a, b", "c"], {}) == ["a", "b", "c"] and generation.model_list(None, {"OPENAI_MODEL": "z"}) == ["z"] and generation.model_list(None, {"OPENAI_SOLVER_MODELS": "p,q"}) == ["p", "q"]


def test_redaction_and_prompts(spark):
    record = GOOD["text_completion"] | {"judge": {"valid": True}, "answer": "A", "extra": 1}
    df = spark.createDataFrame([(json.dumps(record),)], "line string")
    shown = json.loads(jsonl.parse_lines(df).select(F.to_json(generation.redacted(F.col("record"))).alias("j")).first().j)
    assert set(shown) == {"id", "question_type", "stem", "answer_groups", "extra"} and set(shown["answer_groups"][0]) == {"blank", "choices"}
    text = df.select(generation.render("{{SEED_JSON}} and {{ITEM_JSON}}", SEED_JSON=F.lit("see {{ITEM_JSON}}"), ITEM_JSON=F.lit("I")).alias("t")).first().t
    assert text == "see I and I"


def test_judging(spark):
    items = spark.createDataFrame([(1, "a", "s1"), (2, "", "zz"), (3, "a", None)], "item_ord bigint, id string, source_seed_id string")
    outputs = spark.createDataFrame([("a", '{"valid": true, "score": 4.9}'), ("item-2", '{"valid": true, "score": "5"}'), ("gone", "broken"), ("a", '{"valid": 1, "score": 5}')], "item_id string, generation string")
    got = judging.review(outputs, items).select("item_id", "item.item_ord", judging.accepts(F.col("judge")).alias("ok"), F.to_json("judge").alias("j")).collect()
    assert sorted((r.item_id, r.item_ord, r.ok) for r in got if r.item_id != "gone") == [("a", 3, False), ("a", 3, True), ("item-2", 2, True)]
    lost = next(r for r in got if r.item_id == "gone")
    assert lost.item_ord is None and not lost.ok and json.loads(lost.j)["score"] == 1 and json.loads(lost.j)["reason"] == "broken"
    seeds = judging.seed_map(spark.createDataFrame([(1, "s1", "old"), (2, "s1", "new"), (3, None, "none")], "ord bigint, seed_id string, q string"))
    assert sorted((r.key, r.q) for r in seeds.collect()) == [("s1", "new"), ("seed-3", "none")]
    joined = {r.item_ord: r.seed for r in judging.with_seed(items, seeds).collect()}
    assert joined[1].q == "new" and joined[2] is None and joined[3] is None
