"""The stages put together over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examsift.operators import answers, rules, selection, similarity
from examsift.runtime import work_table as table
from examsift.sources.jsonl import parse_lines


def items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "generated_items")


def seeds(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "seed_records")


def line_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of item_lines that are objects, with rule errors."""
    parsed = parse_lines(table(spark, folder, "item_lines").select("file_name", "line_no", "line"))
    return rules.with_errors(parsed.filter("line_error is null"))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Novelty of each item against all seeds."""
    features = similarity.item_features(items(spark, folder), ["item_ord"])
    return similarity.score_novelty(features, similarity.seed_features(seeds(spark, folder)), ["item_ord"])


def graded(spark: SparkSession, folder: str) -> DataFrame:
    return answers.attempts(items(spark, folder), table(spark, folder, "solver_responses"))


def accuracies(spark: SparkSession, folder: str) -> DataFrame:
    return answers.item_accuracy(items(spark, folder), graded(spark, folder))


def evaluated(spark: SparkSession, folder: str, gates: selection.Gates) -> DataFrame:
    """Items with rule errors and gate issues."""
    checked = rules.item_errors(items(spark, folder))
    errors = F.transform("rule_errors", lambda e: e["message"])
    return selection.evaluate(checked, errors, gates).drop("rule_errors")


def selected(spark: SparkSession, folder: str, gates: selection.Gates) -> DataFrame:
    return selection.select(evaluated(spark, folder, gates), gates)


def solve_and_filter(rows: DataFrame, responses: DataFrame, gates: selection.Gates, with_attempts: bool = False) -> DataFrame | tuple[DataFrame, DataFrame]:
    """From items and recorded responses to the selection: grade, attach, validate, gate, rank, cap.

    Alone, the selection holds every attempt in its arrays. For items with very many attempts ask for
    (selection, attempts) by ``with_attempts``: the second holds each graded attempt of each item, and arrays
    of more than MOST_IN_ARRAY attempts are only the first chunk of them in the first.
    """
    graded = answers.attempts(rows, responses)
    solved = answers.attach_results(rows, graded, answers.MOST_IN_ARRAY if with_attempts else None)
    checked = rules.item_errors(solved)
    errors = F.transform("rule_errors", lambda e: e["message"])
    chosen = selection.select(selection.evaluate(checked, errors, gates).drop("rule_errors"), gates)
    return (chosen, graded) if with_attempts else chosen

