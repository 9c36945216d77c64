"""Command line: validate, novelty, solve, filter, judge and generate over JSON lines.

    python -m examsift.plans.cli filter --input items.jsonl --output out --target-size 30

Every command reads JSON lines, writes folders of JSON lines and a summary file, and exits with 1 on an error.
Model calls need a provider: ``--provider module:function`` gives texts for (instructions, system prompts, parameters).
Its answers are kept in ``--cache`` and not asked for again, unless ``--no-cache`` is given.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examsift.operators import answers, generation, judging, rules, selection, similarity
from examsift.operators.sizing import broadcast_if_small
from examsift.runtime import cut_lineage
from examsift.sources import jsonl

ITEM = """id string, question_type string, subtype string, difficulty double, stem string, stimulus string, passage string, passages array<struct<label:string,text:string>>,
answer_groups array<struct<blank:int,choices:array<struct<label:string,text:string>>,correct_labels:array<string>>>, source_seed_id string, novelty_score double, novelty_pass boolean,
novelty_reasons array<string>, solver_accuracy double, solver_results array<struct<model:string,raw_response:string,parse_error:string,correct:boolean>>, judge struct<valid:boolean,score:double>"""
RESPONSE = "item_id string, model string, generation string, response string, answer string"
SEED = "seed_id string, question_id string, source_question string, source_answer string, question_type string"


def session() -> SparkSession:
    """A session with the settings the readers rely on (a JSON object's last value of a repeated key counts)."""
    return SparkSession.builder.appName("examsift").config("spark.sql.variant.allowDuplicateKeys", "true").config("spark.sql.session.timeZone", "UTC").getOrCreate()


#: Prompts used where none is given.
PROMPTS = {
    "generate": "Write {{ITEMS_PER_SEED}} new exam items of the same question type as this seed, without reusing its wording. Answer with one JSON object {\"items\": [...]}.\n\n{{SEED_JSON}}",
    "judge": "Judge the exam item against the seed it was made from. Answer with one JSON object with valid, score (1 to 5), issues and reason.\n\nSeed: {{SEED_JSON}}\n\nItem: {{ITEM_JSON}}",
    "solve": "Answer this exam item. Answer with one JSON object {\"answers\": [{\"blank\": ..., \"labels\": [...]}]}.\n\n{{ITEM_JSON}}",
}
SYSTEM = {"generate": "You write exam items as JSON.", "judge": "You review exam items as JSON.", "solve": "You answer exam items as JSON."}


def read(spark: SparkSession, paths: list[str], kind: str, ord_: str) -> DataFrame:
    """Typed records with ``record`` (VARIANT), ``line`` and ``ord_``: the 1-based number of the record over all files."""
    rows = jsonl.read_records(spark, paths, ord_)
    return rows.select("*", F.from_json("line", kind).alias("_t")).select(ord_, "file_idx", "line_no", "line", "record", "_t.*")


def with_fields(df: DataFrame, added: list[str]) -> DataFrame:
    """The input records with ``added`` columns put in, as lines: unknown keys stay."""
    own = F.map_filter(F.from_json("line", "map<string,variant>"), lambda k, _: ~k.isin(added))
    new = F.from_json(F.to_json(F.struct(*added), {"ignoreNullFields": "false"}), "map<string,variant>")
    return df.select(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(own, new)), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)))).alias("value"), "item_ord")


def write(df: DataFrame, path: str) -> None:
    df.orderBy("item_ord").select("value").write.mode("overwrite").text(path)


def validate(spark: SparkSession, a: argparse.Namespace) -> int:
    checked = cut_lineage(rules.with_errors(jsonl.parse_lines(jsonl.read_lines(spark, a.input), strict=True)).select("line_no", "rule_errors"))
    totals = rules.validation_totals(checked).first()
    errors = checked.filter(F.size("rule_errors") > 0).select("line_no", F.explode(rules.error_texts(F.col("rule_errors"), F.col("line_no"))).alias("value"))
    if a.output:
        errors.orderBy("line_no").select("value").write.mode("overwrite").text(a.output)
    print(f"{totals.errors} errors in {totals.invalid_records} of {totals.records} records")
    return int(totals.errors > 0)


def novelty(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = jsonl.read_records(spark, a.input, "item_ord")
    sources = jsonl.read_records(spark, a.sources, "ord").select("ord", "line")
    scored = cut_lineage(similarity.score_novelty(similarity.record_features(rows, ["item_ord"]), similarity.source_record_features(sources), ["item_ord"], a.threshold))
    names = [c for c in scored.columns if c != "item_ord"]
    write(with_fields(rows.select("item_ord", "line").join(scored, "item_ord"), names), a.output)
    jsonl.write_summary(similarity.novelty_summary(scored, a.threshold), a.summary_output, failure_reasons=similarity.failure_reasons(scored))
    print(f"novelty of {scored.count()} items in {a.output}")
    return 0


def _template(a: argparse.Namespace) -> str:
    return jsonl.read_text(a.prompt) if a.prompt else PROMPTS[a.command]


def provider_of(name: str) -> generation.Provider:
    """The function ``module:function``, imported only when it is asked for."""
    module, _, function = name.partition(":")
    if not module or not function:
        raise ValueError("model calls need --provider module:function")
    try:
        return getattr(importlib.import_module(module), function)
    except ImportError as problem:
        raise ValueError(f"provider {name} cannot be imported ({problem}); install its package or check the name") from problem


def _generate(spark: SparkSession, requests: DataFrame, a: argparse.Namespace) -> DataFrame:
    parameters = {"temperature": a.temperature, "max_new_tokens": a.max_new_tokens, "model": a.model, "json": not a.no_response_format_json}
    asked, keys = generation.require_rows(requests, "input records"), [c for c in requests.columns if c not in ("instruction", "system_prompt")]
    provider = provider_of(a.provider)
    use_cache = a.cache and not a.no_cache
    made = cut_lineage(generation.generate_cached(asked, provider, parameters, keys, a.cache) if use_cache else generation.generate(asked, provider, parameters, keys))
    if a.distiset_dir:
        made.write.mode("overwrite").parquet(os.path.join(a.distiset_dir, generation.slug(a.model)))
    return made


def solve(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = read(spark, a.input, ITEM, "item_ord")
    if a.responses:
        sent = read(spark, a.responses, RESPONSE, "resp_id").withColumn("raw_response", answers.record_response(F.col("record")))
        bad = sent.filter(jsonl.response_errors(F.col("record")).isNotNull()).select("resp_id", jsonl.response_errors(F.col("record")).alias("e")).orderBy("resp_id").first()
        if bad:
            raise ValueError(f"{a.responses[0]}:{bad.resp_id}: {bad.e}")
    else:
        template = _template(a)
        sent = None
        for model in generation.model_list(a.models, dict(os.environ)):
            a.model = model
            prompt = generation.render(template, ITEM_JSON=F.to_json(generation.redacted(F.col("record"))))
            asked = rows.select(answers.item_key(F.col("id"), F.col("item_ord")).alias("item_id"), F.lit(model).alias("model"), prompt.alias("instruction"), F.lit(a.system_prompt or SYSTEM[a.command]).alias("system_prompt"))
            got = _generate(spark, asked, a).withColumns({"response": F.lit(None).cast("string"), "answer": F.lit(None).cast("string")})
            sent = got if sent is None else sent.unionByName(got)
        sent = cut_lineage(sent.withColumn("resp_id", F.monotonically_increasing_id()))
    graded = cut_lineage(answers.attempts(rows, sent))
    named = broadcast_if_small(rows.select("item_ord", answers.item_key(F.col("id"), F.col("item_ord")).alias("item_id")))
    jsonl.write_lines(graded.join(named, "item_ord"), a.attempts_output or a.output.rstrip("/") + "_attempts", ["item_ord", "resp_id"])
    solved = answers.attach_results(rows, graded, answers.MOST_IN_ARRAY)
    write(with_fields(solved, ["solver_results", "solver_accuracy"]), a.output)
    per_item = answers.item_accuracy(rows, graded)
    summary = jsonl.write_summary(answers.solver_summary(per_item), a.summary_output, models=answers.model_totals(graded).select("model", F.struct("total", "correct", "accuracy").alias("m")))
    print(f"{summary['total_solver_attempts']} attempts at {summary['total_items']} items graded")
    return 0


def filter_items(spark: SparkSession, a: argparse.Namespace) -> int:
    gates = selection.Gates(a.target_size, a.min_novelty, a.min_judge_score, a.max_dataset_solver_accuracy, a.max_item_solver_accuracy, a.enforce_solver_target, a.allow_unjudged, a.allow_unscored, a.allow_unsolved)
    rows = read(spark, a.input, ITEM, "item_ord")
    evaluated = selection.evaluate(rules.with_errors(rows), rules.error_texts(F.col("rule_errors"), F.col("item_ord")), gates)
    out = cut_lineage(selection.select(evaluated, gates).select("item_ord", "rank", "fate", "_accuracy", "filter_issues"))
    lines = rows.select("item_ord", "line")
    kept = lines.join(out.filter("fate = 'accepted'").select("item_ord", "rank"), "item_ord")
    kept.orderBy("rank").select(F.col("line").alias("value")).write.mode("overwrite").text(a.output)
    write(with_fields(lines.join(out.filter("fate in ('rejected', 'easiest')").select("item_ord", "filter_issues"), "item_ord"), ["filter_issues"]), a.rejected_output)
    summary = jsonl.write_summary(selection.selection_summary(out, gates), a.summary_output, rejection_reasons=selection.rejection_reasons(out))
    print(f"{summary['accepted_items']} of {summary['input_items']} items accepted")
    return 0


def judge(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = read(spark, a.input, ITEM, "item_ord")
    seeds = judging.seed_map(read(spark, a.seeds, SEED, "ord").select("ord", "seed_id", "question_id", "line")) if a.seeds else spark.createDataFrame([], "key string, line string")
    with_seed = judging.with_seed(rows.withColumnRenamed("judge", "_judge"), seeds)
    prompt = generation.render(_template(a), SEED_JSON=F.coalesce("seed.line", F.lit("{}")), ITEM_JSON=F.col("line"))
    asked = with_seed.select(answers.item_key(F.col("id"), F.col("item_ord")).alias("item_id"), prompt.alias("instruction"), F.lit(a.system_prompt or SYSTEM[a.command]).alias("system_prompt"))
    reviewed = cut_lineage(judging.review(_generate(spark, asked, a), rows.select("item_ord", "id", "line")).select(F.col("item.line").alias("line"), "judge", F.col("item.item_ord").alias("item_ord")))
    write(with_fields(reviewed, ["judge"]), a.reviewed_output)
    passed = reviewed.filter(judging.accepts(F.col("judge"), a.min_score))
    write(with_fields(passed, ["judge"]), a.accepted_output)
    print(f"{passed.count()} of {reviewed.count()} items accepted")
    return 0


def generate(spark: SparkSession, a: argparse.Namespace) -> int:
    seeds = generation.require_rows(read(spark, a.input, SEED, "ord"), "seeds")
    prompt = generation.render(_template(a), SEED_JSON=F.col("line"), ITEMS_PER_SEED=F.lit(str(a.items_per_seed)))
    asked = seeds.select("ord", generation.seed_name(F.col("seed_id"), F.col("ord")).alias("seed_id"), "question_type", F.lit(a.model).alias("model_name"), prompt.alias("instruction"), F.lit(a.system_prompt or SYSTEM[a.command]).alias("system_prompt"))
    parsed = cut_lineage(generation.parse_generations(_generate(spark, asked, a)))
    if a.raw_output:
        jsonl.write_lines(parsed.select("seed_id", "question_type", "model_name", "generation"), a.raw_output)
    failed = generation.failed_generations(parsed)
    if a.failed_output and not failed.isEmpty():
        jsonl.write_lines(failed, a.failed_output)
    items = generation.explode_items(parsed, a.prompt_version, "ord")
    items.orderBy("ord", "pos").select(F.to_json("item").alias("value")).write.mode("overwrite").text(a.output)
    print(f"{items.count()} items from {parsed.count()} generations, {failed.count()} of them failed")
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="examsift", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, **flags) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        c.add_argument("--input", nargs="+", required=True)
        for flag, default in flags.items():
            option = "--" + flag.replace("_", "-")
            if isinstance(default, bool):
                c.add_argument(option, action="store_true")
            elif isinstance(default, list):
                c.add_argument(option, nargs="*", default=default)
            else:
                c.add_argument(option, default=default, type=type(default) if default is not None else None)
        return c

    calls = {"provider": "", "prompt": "", "model": "gpt-4o", "system_prompt": "", "cache": "", "no_cache": False, "distiset_dir": "", "no_response_format_json": False}
    command("validate", validate, output="")
    command("novelty", novelty, sources=[], output="scored", summary_output="novelty_summary.json", threshold=75.0)
    command("solve", solve, output="solved", attempts_output="", summary_output="solver_summary.json", responses=[], models=[], temperature=0.0, max_new_tokens=600, **calls)
    c = command("filter", filter_items, output="accepted", rejected_output="rejected", summary_output="filter_summary.json", target_size=0, min_novelty=75.0, min_judge_score=4.0, max_dataset_solver_accuracy=0.85, enforce_solver_target=False, allow_unjudged=False, allow_unscored=False, allow_unsolved=False)
    c.add_argument("--max-item-solver-accuracy", type=float, default=None)
    command("judge", judge, accepted_output="accepted", reviewed_output="reviewed", seeds=[], min_score=4, temperature=0.0, max_new_tokens=900, **calls)
    command("generate", generate, output="items", raw_output="", failed_output="failed_generations", items_per_seed=2, temperature=0.8, max_new_tokens=2500, prompt_version="v1", **calls)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return a.run(session(), a)
    except Exception as problem:
        print(f"Error: {problem}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
