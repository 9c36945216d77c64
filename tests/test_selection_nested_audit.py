import json
import random

import pytest
from pyspark.sql import functions as F

from examsift.functions import variants as V
from examsift.operators import audit, nested, selection
from examsift.operators.prefix import running_sums
from examsift.operators.sizing import broadcast_if_small, smallest_of_key
from examsift.plans import pipeline
from tests.test_answers_rules import GROUPS, group

ITEM = f"item_ord bigint, id string, question_type string, subtype string, difficulty int, stem string, stimulus string, explanation string, answer_groups {GROUPS}, novelty_score double, solver_accuracy double, solver_results array<struct<correct:boolean>>, judge struct<valid:boolean,score:int>"


def row(n, accuracy=0.5, results=None, judge=(True, 5), novelty=90.0, difficulty=3, ident="i"):
    return (n, ident, "logical_reasoning", "flaw", difficulty, "s", "t", "e", [group(None, ["A"])], novelty, accuracy, results, judge)


def pick(spark, rows, gates):
    e = selection.evaluate(spark.createDataFrame(rows, ITEM), V.texts(), gates)
    return selection.select(e, gates)


def test_gates_and_reasons(spark):
    rows = [row(1), row(2, judge=None), row(3, judge=(False, 2)), row(4, novelty=10.0), row(5, novelty=None), row(6, accuracy=None), row(7, accuracy=None, results=[(True,), (False,), None]), row(8, judge=(True, None)), row(9, novelty=float("nan")), row(10, accuracy=0.95)]
    got = {r.item_ord: r for r in pick(spark, rows, selection.Gates(max_item_accuracy=0.9)).collect()}
    assert {n: r.filter_issues for n, r in got.items() if r.filter_issues} == {
        2: ["judge: missing judge result"],
        3: ["judge: item is not valid", "judge: score below 4"],
        4: ["novelty: score below 75"],
        5: ["novelty: missing novelty_score"],
        6: ["solver: missing solver results"],
        10: ["solver: item accuracy above 0.9"],
    }
    assert got[7].fate == "accepted" and got[7]["rank"] is not None and got[2]["rank"] is None
    loose = selection.Gates(allow_unjudged=True, allow_unscored=True, allow_unsolved=True, min_novelty=0, min_judge_score=0)
    assert sum(r.fate == "rejected" for r in pick(spark, rows, loose).collect()) == 1


def test_hardness_order(spark):
    rows = [row(1, 0.9), row(2, 0.1), row(3, 0.1, difficulty=5), row(4, 0.1, novelty=99.0), row(5, 0.1, judge=(True, 4)), row(6, 0.1, ident="a"), row(7, 0.1, difficulty=None), row(8, None), row(9, 0.1, ident="a")]
    gates = selection.Gates(allow_unsolved=True)
    order = [r.item_ord for r in sorted((r for r in pick(spark, rows, gates).collect()), key=lambda r: r["rank"])]
    assert order == [3, 4, 6, 9, 2, 5, 7, 1, 8]


def pop_loop(rows, size, target):
    kept = sorted(rows, key=lambda r: (1.0 if r[1] is None else r[1], r[0]))
    kept = kept[:size] if size else kept
    while kept:
        known = [a for _, a in kept if a is not None]
        if not known or sum(known) / len(known) <= target + 1e-12:
            break
        kept.pop()
    return {n for n, _ in kept}


@pytest.mark.parametrize("seed", range(6))
def test_accuracy_target_equals_dropping_the_easiest(spark, seed):
    rng = random.Random(seed)
    values = [(i, rng.choice([None, 0.0, 0.25, 0.5, 0.75, 1.0])) for i in range(rng.choice([0, 1, 30]))]
    gates = selection.Gates(target_size=rng.choice([0, 5, 100]), max_dataset_accuracy=rng.choice([0.0, 0.3, 0.5]), enforce_target=True, allow_unsolved=True)
    out = pick(spark, [row(n, a) for n, a in values], gates)
    assert {r.item_ord for r in out.filter("fate = 'accepted'").collect()} == pop_loop(values, gates.target_size, gates.max_dataset_accuracy)
    s = selection.selection_summary(out, gates).first()
    counts = {r.fate: r["count"] for r in out.groupBy("fate").count().collect()}
    assert (s.input_items, s.accepted_items, s.rejected_items) == (len(values), counts.get("accepted", 0), counts.get("easiest", 0))
    assert sum(r["items"] for r in selection.rejection_reasons(out).collect()) == counts.get("easiest", 0)
    assert s.target_size == (gates.target_size or None) and (s.accepted_items or not s.solver_accuracy_target_met)


def test_solve_and_filter_end_to_end(spark):
    items = spark.createDataFrame([row(1, None, ident="hard"), row(2, None, ident="easy"), row(3, None, ident="mid")], ITEM)
    sent = [(i, name, "m", json.dumps({"answer": a}), None, None) for i, (name, a) in enumerate([("hard", "B"), ("hard", "C"), ("easy", "A"), ("mid", "A"), ("mid", "B")])]
    responses = spark.createDataFrame(sent, "resp_id bigint, item_id string, model string, generation string, response string, answer string")
    out = pipeline.solve_and_filter(items, responses, selection.Gates(target_size=1, enforce_target=True)).collect()
    assert {r.id: r.fate for r in out} == {"hard": "accepted", "easy": "overflow", "mid": "overflow"}
    assert next(r for r in out if r.id == "hard").solver_accuracy == 0.0


def test_solve_and_filter_returns_the_attempts(spark, monkeypatch):
    items = spark.createDataFrame([row(1, None, ident="hot"), row(2, None, ident="mid")], ITEM)
    sent = [(i, "hot" if i < 5 else "mid", "m", json.dumps({"answer": "B"}), None, None) for i in range(7)]
    responses = spark.createDataFrame(sent, "resp_id bigint, item_id string, model string, generation string, response string, answer string")
    monkeypatch.setattr(pipeline.answers, "MOST_IN_ARRAY", 3)
    alone = pipeline.solve_and_filter(items, responses, selection.Gates())
    assert {r.id: len(r.solver_results) for r in alone.collect()} == {"hot": 5, "mid": 2}
    chosen, attempts = pipeline.solve_and_filter(items, responses, selection.Gates(), with_attempts=True)
    chunked = sum(r.n for r in pipeline.answers.result_chunks(attempts, 3).filter("chunk = 0 and item_ord = 1").selectExpr("size(solver_results) n").collect())
    assert {r.id: r.solver_results and len(r.solver_results) for r in chosen.collect()} == {"hot": chunked, "mid": 2}
    assert {r.id: r.n_attempts for r in chosen.collect()} == {"hot": 5, "mid": 2} and chunked < 5
    assert sorted((r.item_ord, r.resp_id) for r in attempts.collect()) == [(1 if i < 5 else 2, i) for i in range(7)]


def test_running_sums_over_many_partitions(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v")).repartition(9)
    got = running_sums(df, [F.col("v").desc(), F.col("id")], {"s": F.col("id"), "n": F.lit(1).cast("long")}).collect()
    order = sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == order
    total = 0
    for r in sorted(got, key=lambda r: r.n):
        total += r.id
        assert r.s == total
    assert running_sums(df.limit(0), [F.col("id")], {"s": F.col("id")}).collect() == []


def test_smallest_of_key_both_ways(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(600)] + [(None, "hot"), (700, None), (701, None)]
    df = spark.createDataFrame(rows, "id bigint, key string")
    usual = sorted(map(str, smallest_of_key(df, "key", "id", 10_000).collect()))
    assert usual == sorted(map(str, smallest_of_key(df, "key", "id", 50).collect())) and len(usual) == 603
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 10)._jdf.queryExecution().logical().toString().lower()


LINES = [
    '{"passages": ["a", {"text": "b"}, 3, null], "answer_groups": [{"choices": {"A": "x", "B": "y"}, "correct_labels": "A"}, 7, {"choices": [{"label": "A"}, "s", {}]}], "judge": "{\\"issues\\": [\\"i\\", 2, \\"j\\"]}"}',
    '{"solver_results": {"expected": [{"blank": 1}, "x"], "predicted": {"labels": []}}, "passages": "alone", "answer_groups": "[{\\"correct_labels\\": [\\"A\\", 1, \\"B\\"]}]"}',
    '{"judge": [{"issues": ["no"]}], "answer_groups": "not json", "other": {"judge": {"issues": ["deep"]}}}',
    "[1]", "null", "", "   ", "{broken", '"{}"', None, "{}",
]
WANT = [
    (0, "answer_group", -1, 0), (0, "answer_group", -1, 2), (0, "choice", 0, 0), (0, "choice", 0, 1), (0, "choice", 2, 0), (0, "choice", 2, 2),
    (0, "correct_label", 0, 0), (0, "judge", -1, 0), (0, "judge_issue", 0, 0), (0, "judge_issue", 0, 2), (0, "passage", -1, 0), (0, "passage", -1, 1),
    (1, "answer_group", -1, 0), (1, "correct_label", 0, 0), (1, "correct_label", 0, 2), (1, "expected", 0, 0), (1, "passage", -1, 0), (1, "predicted", 0, 0),
    (1, "solver_result", -1, 0),
]


def test_children_of_nested_lines(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(LINES)], "line_no bigint, line string, node string")
    assert sorted(map(tuple, nested.child_rows(df).collect())) == sorted(WANT)
    twice = df.filter("line_no < 2").unionByName(df.filter("line_no < 2"))
    assert sorted(map(tuple, nested.child_rows(twice).collect())) == sorted(WANT * 2)
    assert nested.child_rows(df.limit(0)).collect() == []


def test_intervals_nest_and_tables_have_fields(spark):
    df = spark.createDataFrame([(0, LINES[0])], "line_no bigint, line string")
    nodes = nested.node_table(df)
    all_nodes = nodes.collect()
    root = next(n for n in all_nodes if n.node == "item")
    for n in all_nodes:
        if n.node == "item":
            continue
        above = [m for m in all_nodes if m.pre < n.pre and m.post > n.post]
        assert root in above and max(above, key=lambda m: m.pre).node == nested.PARENT[n.node]
    assert [(r.label, r.text) for r in nested.typed_table(nodes, "choice").orderBy("pre").collect()] == [("A", "x"), ("B", "y"), ("A", None), (None, None)]
    deep = spark.createDataFrame([(1, '{"judge": {"issues": ["a"]}, "x": ' + "[" * 500 + "]" * 500 + "}")], "line_no bigint, line string")
    assert sorted(r.child for r in nested.child_rows(deep).collect()) == ["judge", "judge_issue"]


def test_audits(spark):
    kind = f"id string, question_type string, subtype string, difficulty int, skill_tags array<string>, passage string, passages array<struct<label:string,text:string>>, passage_id string, answer_groups {GROUPS}"
    rows = [
        ("x-001", "reading_comprehension", "a", 3, ["t", "u"], "one two three", None, "p", [group(None, ["A"])]),
        ("x-002", "reading_comprehension", "a", 9, ["T", "u"], "one two three", None, "p", [group(None, ["A", "B"])]),
        ("x-002", "text_completion", None, None, None, "extra", [("A", "t")], None, [group(None, ["C"])]),
        (None, None, None, 1, ["t"], None, None, "q", None),
    ]
    df = spark.createDataFrame(rows, kind)
    assert {tuple(r) for r in audit.quota(df, F.col("question_type"), {"reading_comprehension": 2, "missing": 1}).collect()} == {("reading_comprehension", 2, 2, True), ("missing", 1, 0, False), ("text_completion", 0, 1, False), (None, 0, 1, False)}
    assert {tuple(r) for r in audit.set_sizes(df, "passage_id", F.col("passage"), 2).collect()} == {("p", 2, 1, True), ("q", 1, 1, False)}
    assert tuple(audit.identifiers(df, "^x-[0-9]{3}$").first()) == (4, 1, 0, 1)
    assert [r.id for r in audit.numbering(df, "x-", 3, 3).collect()] == ["x-003"]
    assert {r.rule: r.broken for r in audit.field_rules(df).collect()} == {"difficulty 1 to 5": 2, "two to five tags": 2, "tags in lower case": 1, "passage on reading items only": 1}
    assert tuple(audit.word_range(df, F.col("passage"), 2, 2).first()) == (3, 1, 2)
    assert {r.label: r.answers for r in audit.label_balance(df).collect()} == {"A": 1, "C": 1} and audit.balance_gap(df).first().gap == 0.0
    assert [tuple(r) for r in audit.passage_counts(df).collect()] == [(None, 1, 1)]
    flags = spark.createDataFrame([({"a": True},), ({"a": True, "b": None},), ({},), (None,)], "m map<string,boolean>")
    assert [r[0] for r in flags.select(audit.flags_all_true(F.col("m"))).collect()] == [True, False, False, False]
    assert tuple(audit.share_of(df, F.col("difficulty") > 2, 0.5).first()) == (4, 0.5, True)
    assert audit.label_balance(df.limit(0)).collect() == []


def test_streams(spark, tmp_path):
    from examsift.streaming import stages

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": "a"}\n\nbroken\n')
    q = stages.write_stream(stages.validate_stream(stages.read_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {r.line: (r.line_error, len(r.rule_errors or [])) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got['{"id": "a"}'][0] is None and got['{"id": "a"}'][1] >= 4 and got["broken"][0] == "invalid JSON"
