import json

from pyspark.sql import functions as F

from examsift.operators import answers
from examsift.sources import jsonl
from examsift.streaming import stages
from tests.test_answers_rules import CASES, GOOD, GROUPS, group


def run(df, tmp_path, name):
    stages.write_stream(df, str(tmp_path / name), str(tmp_path / f"{name}_state")).awaitTermination()
    return df.sparkSession.read.parquet(str(tmp_path / name))


def test_lines_are_validated_as_they_come(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        (tmp_path / "in" / f"{n}.jsonl").write_text("\n".join([json.dumps(r) for r, _ in CASES[n::3]] + ["", "{broken"]))
    got = run(stages.validate_stream(stages.read_stream(spark, str(tmp_path / "in"))), tmp_path, "out").collect()
    assert len(got) == len(CASES) + 3 and sum(r.line_error is not None for r in got) == 3
    said = sorted(sorted({e.rule for e in r.rule_errors}) for r in got if r.line_error is None)
    assert said == sorted(sorted(want) for _, want in CASES)


def test_responses_are_graded_and_counted_by_window(spark, tmp_path):
    items = spark.createDataFrame([(1, "a", [group(None, ["B"])]), (2, "b", [group(None, ["C"])])], f"item_ord bigint, id string, answer_groups {GROUPS}")
    rows = [(i, "ab"[i % 2], "m" if i < 6 else "n", json.dumps({"answer": "B"}), None, None, f"2024-05-01 0{i // 4}:1{i % 4}:00") for i in range(8)]
    sent = spark.createDataFrame(rows, "resp_id bigint, item_id string, model string, generation string, response string, answer string, at string").withColumn("at", F.to_timestamp("at"))
    sent.write.parquet(str(tmp_path / "sent"))
    stream = spark.readStream.schema(sent.schema).parquet(str(tmp_path / "sent"))
    graded = run(stages.grade_stream(stream, items, ("at",)), tmp_path, "graded")
    batch = answers.attempts(items, sent)
    assert sorted((r.item_ord, r.resp_id, r.correct) for r in graded.collect()) == sorted((r.item_ord, r.resp_id, r.correct) for r in batch.collect())
    again = spark.readStream.schema(graded.schema).parquet(str(tmp_path / "graded"))
    query = stages.accuracy_by_window(again, "at").writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "w")).start()
    query.awaitTermination()
    got = sorted((r["window"].start.hour, r.model, r.total, r.correct) for r in spark.table("windows").collect())
    assert got == [(0, "m", 4, 2), (1, "m", 2, 1), (1, "n", 2, 1)]


def test_numbers_follow_the_order_of_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.jsonl").write_text("\n".join(json.dumps(GOOD["single"] | {"id": f"{n}-{k}"}) + ("\n" if k % 50 == 0 else "") for k in range(200)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        paths = [str(tmp_path / f"{n}.jsonl") for n in (2, 0, 1)]
        got = jsonl.read_records(spark, paths, "ord").select("ord", "file_idx", "line_no", F.get_json_object("line", "$.id").alias("id"))
        assert got.rdd.getNumPartitions() > 3
        rows = sorted(got.collect(), key=lambda r: r.ord)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.id for r in rows] == [f"{n}-{k}" for n in (2, 0, 1) for k in range(200)] and [r.ord for r in rows] == list(range(1, 601))
    assert [r.line_no for r in rows[:3]] == [1, 3, 4] and rows[200].line_no == 1
