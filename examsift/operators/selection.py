"""Gates, hardness order, caps and the accuracy target: which items are kept, and why the others are not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.functions.constants import LEAST_JUDGE_SCORE, MOST_DATASET_ACCURACY, NOVELTY_THRESHOLD
from examsift.operators.prefix import running_sums
from examsift.runtime import cut_lineage


@dataclass(frozen=True)
class Gates:
    """Thresholds of a selection."""

    target_size: int = 0
    min_novelty: float = NOVELTY_THRESHOLD
    min_judge_score: float = LEAST_JUDGE_SCORE
    max_dataset_accuracy: float = MOST_DATASET_ACCURACY
    max_item_accuracy: float | None = None
    enforce_target: bool = False
    allow_unjudged: bool = False
    allow_unscored: bool = False
    allow_unsolved: bool = False


def accuracy(existing: Column, results: Column) -> Column:
    """Solver accuracy of an item: the one it carries, else the share of its results that are correct; null without either."""
    kept = F.filter(results, lambda r: r.isNotNull())
    right = F.size(F.filter(kept, lambda r: r["correct"].eqNullSafe(True)))
    return F.coalesce(existing, F.when(F.size(kept) > 0, right / F.size(kept)))


def gate_issues(schema_errors: Column, gates: Gates, novelty_pass: Column | None = None, novelty_reasons: Column | None = None) -> Column:
    """ARRAY<STRING>: why an item is rejected, in the order of the gates; empty for an item that passes.

    NaN counts as a number that is below no limit. A missing score of a judged item is no issue.
    """
    judge, novelty, acc = F.col("judge"), F.col("novelty_score"), F.col("_accuracy")
    passed = F.lit(True) if novelty_pass is None else novelty_pass
    reasons = F.array().cast("array<string>") if novelty_reasons is None else F.coalesce(novelty_reasons, F.array().cast("array<string>"))

    def below(x: Column, least: float) -> Column:
        return ~F.isnan(x.cast("double")) & (x < least)

    checks = [
        F.when(judge.isNotNull() & ~judge["valid"].eqNullSafe(True), F.lit("judge: item is not valid")),
        F.when(judge.isNotNull() & below(judge["score"], gates.min_judge_score), F.lit(f"judge: score below {gates.min_judge_score:g}")),
        F.when(judge.isNull() & F.lit(not gates.allow_unjudged), F.lit("judge: missing judge result")),
        F.when(below(novelty, gates.min_novelty), F.lit(f"novelty: score below {gates.min_novelty:g}")),
        F.when(novelty.isNull() & F.lit(not gates.allow_unscored), F.lit("novelty: missing novelty_score")),
        F.when(passed.eqNullSafe(False), F.when(F.size(reasons) > 0, F.concat(F.lit("novelty: "), F.array_join(reasons, "; "))).otherwise(F.lit("novelty: failed novelty gate"))),
        F.when(acc.isNull() & F.lit(not gates.allow_unsolved), F.lit("solver: missing solver results")),
    ]
    if gates.max_item_accuracy is not None:
        checks.append(F.when(acc > gates.max_item_accuracy, F.lit(f"solver: item accuracy above {gates.max_item_accuracy:g}")))
    return F.concat(F.transform(schema_errors, lambda e: F.concat(F.lit("schema: "), e)), F.array_compact(F.array(*checks)))


def evaluate(items: DataFrame, schema_errors: Column, gates: Gates) -> DataFrame:
    """``items`` (typed) with ``_accuracy`` and ``filter_issues``."""
    has = set(items.columns)
    rated = items.withColumn("_accuracy", accuracy(F.col("solver_accuracy"), F.col("solver_results")))
    extra = (F.col("novelty_pass") if "novelty_pass" in has else None, F.col("novelty_reasons") if "novelty_reasons" in has else None)
    return rated.withColumn("filter_issues", gate_issues(schema_errors, gates, *extra))


def hardness_order() -> list[Column]:
    """Hardest first: accuracy (none is 1), then difficulty, novelty and judge score from high to low (none is 0), then
    id as text, then item_ord."""

    def descending(x: Column) -> Column:
        value = x.cast("double")
        return F.coalesce(F.when(F.isnan(value), None).otherwise(-value), F.lit(0.0))

    return [
        F.coalesce("_accuracy", F.lit(1.0)),
        descending(F.col("difficulty")),
        descending(F.col("novelty_score")),
        descending(F.col("judge.score")),
        F.coalesce("id", F.lit("")),
        F.col("item_ord"),
    ]


def ranked(candidates: DataFrame) -> DataFrame:
    """(item_ord, _accuracy, rank, _known, _sum) of candidates: rank by hardness and the running count and sum of accuracies.

    Only the columns of the order are sorted and written, whatever else the rows hold; item_ord tells rows apart.
    """
    names = [f"_o{k}" for k in range(len(hardness_order()))]
    lean = candidates.select("item_ord", "_accuracy", *[e.alias(n) for e, n in zip(hardness_order(), names)])
    exact = F.col("_accuracy").cast("decimal(20,10)")
    placed = running_sums(lean, [F.col(n) for n in names], {"rank": F.lit(1).cast("long"), "_known": F.when(exact.isNotNull(), 1).otherwise(0).cast("long"), "_sum": exact})
    return placed.select("item_ord", "_accuracy", "rank", "_known", "_sum")


def select(evaluated: DataFrame, gates: Gates) -> DataFrame:
    """``evaluated`` with ``rank`` (candidates) and ``fate``: accepted, rejected, easiest (cut to meet the accuracy
    target) or overflow (beyond the target size; neither accepted nor rejected).

    The accuracy target keeps the longest prefix of the hardness order whose mean accuracy is unknown or
    within the target; since the order starts with the hardest, that is what dropping the easiest item
    until the mean fits leaves. Ranks are found on narrow rows and joined back by item_ord, which tells rows apart;
    rejected rows are not moved.
    """
    issues = F.size("filter_issues") > 0
    placed = ranked(evaluated.filter(~issues))
    capped = F.col("rank") <= gates.target_size if gates.target_size else F.lit(True)
    if gates.enforce_target:
        placed = cut_lineage(placed)
        fits = (F.col("_known") == 0) | (F.col("_sum") <= F.col("_known") * F.lit(str(gates.max_dataset_accuracy)).cast("decimal(20,10)"))
        last = placed.filter(capped & fits).agg(F.max("rank")).first()[0] or 0
        fate = F.when(~capped, "overflow").when(F.col("rank") <= last, "accepted").otherwise("easiest")
    else:
        fate = F.when(capped, "accepted").otherwise("overflow")
    out = evaluated.filter(~issues).join(placed.select("item_ord", "rank", fate.alias("fate")), "item_ord")
    said = F.array(F.lit(f"solver: removed to meet dataset accuracy target {gates.max_dataset_accuracy:g}"))
    out = out.withColumn("filter_issues", F.when(F.col("fate") == "easiest", said).otherwise(F.col("filter_issues")))
    rejected = evaluated.filter(issues).withColumns({"rank": F.lit(None).cast("long"), "fate": F.lit("rejected")})
    return out.unionByName(rejected)


def selection_summary(selected: DataFrame, gates: Gates) -> DataFrame:
    """One row: counts, the parameters, and the accuracy reached; the target is unmet if nothing is accepted or solved."""
    taken = F.col("fate") == "accepted"
    mean = F.avg(F.when(taken, F.col("_accuracy")))
    return selected.agg(
        F.count(F.lit(1)).alias("input_items"),
        F.count_if(F.col("rank").isNotNull()).alias("candidate_items"),
        F.count_if(taken).alias("accepted_items"),
        F.count_if(F.col("fate").isin("rejected", "easiest")).alias("rejected_items"),
        F.lit(gates.target_size or None).cast("int").alias("target_size"),
        F.lit(gates.min_novelty).alias("min_novelty"),
        F.lit(gates.min_judge_score).alias("min_judge_score"),
        F.lit(gates.max_dataset_accuracy).alias("max_dataset_solver_accuracy"),
        F.round(mean, 4).alias("dataset_solver_accuracy"),
        F.coalesce(mean <= gates.max_dataset_accuracy, F.lit(False)).alias("solver_accuracy_target_met"),
        F.lit(gates.enforce_target).alias("enforced_solver_target"),
    )


def rejection_reasons(selected: DataFrame) -> DataFrame:
    """(reason, items) over rejected items, those cut for the accuracy target too."""
    gone = selected.filter(F.col("fate").isin("rejected", "easiest"))
    return gone.select(F.explode("filter_issues").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))
