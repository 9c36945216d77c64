import json

from examsift.plans import cli
from tests.test_answers_rules import GOOD, group


def lines(folder):
    return [json.loads(x) for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def echo(texts, systems, parameters):
    return ['{"valid": true, "score": 5}' if "JUDGE" in t else '{"items": [{"stem": "new"}]}' if "MAKE" in t else '{"answer": "A"}' for t in texts]


def test_solve_writes_each_attempt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    monkeypatch.setattr(cli.answers, "MOST_IN_ARRAY", 2)
    (tmp_path / "items.jsonl").write_text(json.dumps(GOOD["logical_reasoning"] | {"id": "hot"}))
    (tmp_path / "responses.jsonl").write_text("\n".join(json.dumps({"item_id": "hot", "model": "m", "answer": json.dumps({"answer": x})}) for x in "AAB"))
    assert cli.main(["solve", "--input", str(tmp_path / "items.jsonl"), "--responses", str(tmp_path / "responses.jsonl"), "--output", str(tmp_path / "solved"), "--summary-output", str(tmp_path / "s.json")]) == 0
    solved = lines(tmp_path / "solved")[0]
    assert solved["solver_results"] is not None and len(solved["solver_results"]) < 3 and solved["solver_accuracy"] == 0.6667
    assert [(x["item_id"], x["resp_id"], x["correct"]) for x in lines(tmp_path / "solved_attempts")] == [("hot", 1, True), ("hot", 2, True), ("hot", 3, False)]


def counting(texts, systems, parameters):
    with open(texts[0].split("LOG ")[1].split()[0], "a") as f:
        f.write("".join("x\n" for _ in texts))
    return ['{"answer": "A"}' for _ in texts]


def test_requests_are_kept(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "session", lambda: spark)
    (tmp_path / "items.jsonl").write_text("\n".join(json.dumps(GOOD["logical_reasoning"] | {"id": i}) for i in ("a", "b", "a")))
    (tmp_path / "prompt.md").write_text(f"LOG {tmp_path / 'log'} {{{{ITEM_JSON}}}}")
    ask = ["solve", "--input", str(tmp_path / "items.jsonl"), "--prompt", str(tmp_path / "prompt.md"), "--provider", "tests.test_cli:counting", "--models", "m/1", "--output", str(tmp_path / "out"), "--summary-output", str(tmp_path / "s.json"), "--cache", str(tmp_path / "kept"), "--distiset-dir", str(tmp_path / "sets")]
    asked = lambda: len((tmp_path / "log").read_text().split())
    assert cli.main(ask) == 0 and asked() == 2  # two different requests
    assert cli.main(ask) == 0 and asked() == 2  # all answered from the cache
    assert spark.read.parquet(str(tmp_path / "sets" / "m-1")).count() == 3
    assert cli.main([*ask, "--no-cache"]) == 0 and asked() == 5
    assert cli.main(ask[:ask.index("--provider")] + ["--models", "m"]) == 1 and "--provider module:function" in capsys.readouterr().err
    assert cli.main(["judge", "--input", str(tmp_path / "items.jsonl"), "--provider", "no_such_module:f"]) == 1 and "cannot be imported" in capsys.readouterr().err


STORY = "In 1912 the librarian Marlow Quist hid a brass astrolabe beneath the cathedral floor, and nobody in the harbour town of Velmora ever admitted having seen it."
COPIES = [
    ({"passages": [STORY]}, {"seed_id": "s", "source_question": STORY}),
    ({"passages": [{"label": "A", "text": STORY}]}, {"id": 7, "stem": STORY}),
    ({"question": STORY}, {"question_id": "q", "source_question": STORY}),
    ({"question": STORY}, {"source_seed_id": "z", "passages": [STORY]}),
    ({"stem": STORY}, {"question": STORY}),
    ({"stimulus": STORY, "passages": 5, "answer_groups": "x"}, {"seed_id": "", "question_id": None, "passage": STORY}),
]


def test_copies_fail_wherever_they_stand(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    other = {"stem": "Wholly different words about tides."}
    (tmp_path / "items.jsonl").write_text("\n".join(json.dumps(i) for i, _ in COPIES) + "\n" + json.dumps(other))
    for n, (item, source) in enumerate(COPIES):
        (tmp_path / "items.jsonl").write_text(json.dumps(item) + "\n" + json.dumps(other))
        (tmp_path / "sources.jsonl").write_text(json.dumps({"stem": "nothing alike"}) + "\n" + json.dumps(source))
        assert cli.main(["novelty", "--input", str(tmp_path / "items.jsonl"), "--sources", str(tmp_path / "sources.jsonl"), "--output", str(tmp_path / "out"), "--summary-output", str(tmp_path / "s.json")]) == 0
        copy, fresh = lines(tmp_path / "out")
        assert copy["novelty_score"] < 75 and not copy["novelty_pass"] and fresh["novelty_pass"], n
        assert copy["max_similarity_source_id"] == ["s", "7", "q", "z", "source-2", "source-2"][n]
        assert copy["max_similarity_score"] == round(100 - copy["novelty_score"], 1)


def test_commands(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "session", lambda: spark)
    items = [GOOD["logical_reasoning"] | {"id": "one", "extra": {"k": [1]}}, GOOD["single"] | {"id": "two", "answer_groups": [group(None, ["B"])]}]
    (tmp_path / "items.jsonl").write_text("\n".join(map(json.dumps, items)) + "\n\n")
    (tmp_path / "seeds.jsonl").write_text(json.dumps({"seed_id": "s", "source_question": "Unlike anything. Choices: A. q"}))
    (tmp_path / "responses.jsonl").write_text("\n".join(json.dumps({"item_id": i, "model": "m", "answer": '{"answer": "A"}'}) for i in ("one", "two", "gone")))
    (tmp_path / "prompt.md").write_text("JUDGE {{ITEM_JSON}} by {{SEED_JSON}}")
    (tmp_path / "make.md").write_text("MAKE {{ITEMS_PER_SEED}} of {{SEED_JSON}}")
    at = lambda n: str(tmp_path / n)
    ask = ["--provider", "tests.test_cli:echo", "--prompt"]
    assert cli.main(["validate", "--input", at("items.jsonl")]) == 0
    assert cli.main(["novelty", "--input", at("items.jsonl"), "--sources", at("seeds.jsonl"), "--output", at("scored"), "--summary-output", at("n.json")]) == 0
    scored = lines(tmp_path / "scored")
    assert [r["id"] for r in scored] == ["one", "two"] and scored[0]["extra"] == {"k": [1]} and scored[0]["novelty_pass"] is True
    scored_file = tmp_path / "scored.jsonl"
    scored_file.write_text("\n".join(map(json.dumps, scored)))
    assert cli.main(["judge", "--input", str(scored_file), "--seeds", at("seeds.jsonl"), *ask, at("prompt.md"), "--reviewed-output", at("reviewed"), "--accepted-output", at("ok")]) == 0
    assert len(lines(tmp_path / "ok")) == 2
    reviewed_file = tmp_path / "reviewed.jsonl"
    reviewed_file.write_text("\n".join(map(json.dumps, lines(tmp_path / "reviewed"))))
    assert cli.main(["solve", "--input", str(reviewed_file), "--responses", at("responses.jsonl"), "--output", at("solved"), "--summary-output", at("s.json")]) == 0
    assert json.loads((tmp_path / "s.json").read_text())["models"]["m"]["total"] == 2
    solved_file = tmp_path / "solved.jsonl"
    solved_file.write_text("\n".join(map(json.dumps, lines(tmp_path / "solved"))))
    assert cli.main(["filter", "--input", str(solved_file), "--output", at("accepted"), "--rejected-output", at("rejected"), "--summary-output", at("f.json"), "--enforce-solver-target", "--max-dataset-solver-accuracy", "0.4"]) == 0
    assert [r["id"] for r in lines(tmp_path / "accepted")] == ["two"]
    assert lines(tmp_path / "rejected")[0]["filter_issues"] == ["solver: removed to meet dataset accuracy target 0.4"]
    assert cli.main(["generate", "--input", at("seeds.jsonl"), *ask, at("make.md"), "--output", at("made")]) == 0
    assert lines(tmp_path / "made")[0]["id"] == "synthetic-s-001"
    (tmp_path / "bad.jsonl").write_text("[1]\n")
    assert cli.main(["validate", "--input", at("bad.jsonl")]) == 1
    assert "row must be a JSON object" in capsys.readouterr().err
