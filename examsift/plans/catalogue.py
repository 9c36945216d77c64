"""Queries by name over the test tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examsift.functions import text as X
from examsift.functions import variants as V
from examsift.operators import answers, audit, generation, judging, nested, rules, selection, similarity
from examsift.plans import pipeline
from examsift.plans.oracles import oracle_sql  # noqa: F401
from examsift.runtime import work_table as table
from examsift.sources import jsonl

GATES = selection.Gates(allow_unjudged=True)
STRICT = selection.Gates(enforce_target=True, max_dataset_accuracy=0.6, max_item_accuracy=0.9)
CAPPED = selection.Gates(target_size=50, enforce_target=True, max_dataset_accuracy=0.3, allow_unjudged=True, allow_unsolved=True, allow_unscored=True)
#: Stands in for an answer key file.
KEY = '{"arithmetic": {"Q1": "C", "Q2": "A", "Q3": "E"}, "sequences": {"Q1": "B", "Q2": "D"}}'


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested.child_rows(table(spark, folder, "item_lines"))


def p3_choices(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of choices, each with the position of its group."""
    return nested.typed_children(table(spark, folder, "item_lines"), "choice")


# --- scans and projections


def jsonl_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by what reading them gives."""
    lines = table(spark, folder, "item_lines")
    parsed = jsonl.parse_lines(lines).groupBy(F.coalesce("line_error", F.lit("record")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_lines"))
    blank = lines.filter(F.regexp_replace(F.coalesce("line", F.lit("")), r"(?U)\s+", "") == "").agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit("blank").alias("outcome"), "n_lines")
    return parsed.unionByName(blank.filter("n_lines > 0"))


def record_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    own = pipeline.items(spark, folder)
    return own.select("item_ord", answers.item_key(F.col("id"), F.col("item_ord")).alias("item_key"), generation.seed_name(F.col("source_seed_id"), F.col("item_ord")).alias("seed_name"), generation.pipeline_name(F.coalesce("generation_model", F.lit("None"))).alias("slug"))


def answer_key_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return jsonl.answer_key(spark, KEY)


def normalized_texts(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select("doc_id", F.md5(X.squeeze(F.col("text")).cast("binary")).alias("squeezed"), F.md5(X.match_form(F.col("text")).cast("binary")).alias("matched"))


def content_token_stats(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").withColumn("_t", X.content_tokens(F.col("text")))
    return d.select("doc_id", F.size("_t").alias("n_tokens"), F.size(F.array_distinct("_t")).alias("n_distinct"), F.size(X.ngrams(F.col("_t"), 3)).alias("n_trigrams"), F.size(X.ngrams(F.col("_t"), 4)).alias("n_fourgrams"))


def abstract_structures(spark: SparkSession, folder: str) -> DataFrame:
    s = pipeline.seeds(spark, folder)
    return s.groupBy(X.abstract_structure(X.structure_text(F.col("source_question"))).alias("structure")).agg(F.count(F.lit(1)).alias("seeds"))


def seed_choices(spark: SparkSession, folder: str) -> DataFrame:
    s = pipeline.seeds(spark, folder)
    return s.select("seed_id", "source_question", F.array_join(X.labeled_choices(X.squeeze(F.col("source_question"))), "|").alias("choices"))


def distinctive_terms(spark: SparkSession, folder: str) -> DataFrame:
    features = similarity.item_features(pipeline.items(spark, folder), ["item_ord"])
    return features.select("item_ord", F.array_join("terms", "|").alias("terms"))


def main_texts(spark: SparkSession, folder: str) -> DataFrame:
    i = pipeline.items(spark, folder)
    passages = X.passage_texts(F.col("passage"), F.col("passages"))
    choices = X.choice_texts(F.col("answer_groups"), F.col("stem"))
    i = i.withColumns({"_p": passages, "_c": choices})
    passages, choices = F.col("_p"), F.col("_c")
    return i.select("item_ord", F.md5(X.item_text(F.col("stimulus"), passages, F.col("stem"), choices).cast("binary")).alias("main_text"), F.md5(X.item_structure_text(F.col("stimulus"), passages, F.col("stem")).cast("binary")).alias("structure_text"), F.size(choices).alias("n_choices"), F.size(passages).alias("n_passages"))


# --- similarity


def novelty_lexical_riskiest(spark: SparkSession, folder: str) -> DataFrame:
    features = similarity.item_features(pipeline.items(spark, folder), ["item_ord"]).select("item_ord", "tokens")
    return similarity.lexical_riskiest(features, similarity.seed_features(pipeline.seeds(spark, folder)), ["item_ord"])


def own_seed_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Set measures between each item and the seed it was made from; a shuffled equi-join."""
    i = similarity.item_features(pipeline.items(spark, folder), ["item_ord", "source_seed_id"])
    s = similarity.seed_features(pipeline.seeds(spark, folder))
    first = s.groupBy("source_id").agg(F.min_by(F.struct("tokens", "terms"), "ord").alias("s"))
    joined = i.join(judging.broadcast_if_small(first), F.col("source_seed_id") == F.col("source_id"))
    reuse = similarity.entity_reuse(F.col("terms"), F.col("s.terms"))
    return joined.select("item_ord", "source_id", F.round(similarity.lexical_similarity(F.col("tokens"), F.col("s.tokens")), 6).alias("lexical"), F.round(reuse["share"], 6).alias("entity"), F.array_join(reuse["terms"], "|").alias("reused"))


def own_seed_phrases(spark: SparkSession, folder: str) -> DataFrame:
    passages = X.passage_texts(F.col("passage"), F.col("passages"))
    text = X.item_text(F.col("stimulus"), passages, F.col("stem"), X.choice_texts(F.col("answer_groups"), F.col("stem")))
    own = pipeline.items(spark, folder).select("item_ord", "source_seed_id", X.content_tokens(text).alias("_i"))
    numbered = similarity.number_rows(pipeline.seeds(spark, folder), ["seed_id", "source_question"])
    first = numbered.groupBy("seed_id").agg(F.min_by("source_question", "ord").alias("_q")).select("seed_id", X.content_tokens(X.squeeze(F.col("_q"))).alias("_w"))
    joined = own.join(judging.broadcast_if_small(first), F.col("source_seed_id") == F.col("seed_id"))
    return joined.select("item_ord", "seed_id", F.round(similarity.phrase_similarity(F.col("_i"), F.col("_w")), 6).alias("phrase"))


def novelty_full(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.scored(spark, folder)


def novelty_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Novelty without comparisons of sequences: words, phrases, choices (equal or of the same words), names and numbers."""
    features = similarity.item_features(pipeline.items(spark, folder), ["item_ord"])
    scored = similarity.score_novelty(features, similarity.seed_features(pipeline.seeds(spark, folder)), ["item_ord"], ratios=False)
    return scored.select("item_ord", "novelty_score", F.col("max_similarity_source_id").alias("source_id"), "max_similarity_score", "novelty_components.*", "novelty_pass", F.array_join("copied_answer_choices", "|").alias("copied"), F.array_join("reused_distinctive_terms", "|").alias("reused"), F.array_join("novelty_reasons", "|").alias("reasons"))


def line_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts taken from raw records of any shape."""
    texts = similarity.record_texts(pipeline.line_records(spark, folder))
    return texts.select("line_no", F.md5(F.col("_text").cast("binary")).alias("text"), F.md5(F.col("_structure").cast("binary")).alias("structure"), F.array_join("_choices", "|").alias("choices"))


def line_novelty(spark: SparkSession, folder: str) -> DataFrame:
    """Raw records scored against raw records: which line each is most like in its words, itself and its repeats aside."""
    own = pipeline.line_records(spark, folder).select("line_no", "line")
    sources = own.filter("line_no % 2 = 0").select(F.col("line_no").alias("ord"), "line")
    features = similarity.record_features(own.filter("line_no % 2 = 1"), ["line_no"]).select("line_no", "tokens")
    return similarity.lexical_riskiest(features, similarity.source_record_features(sources), ["line_no"])


def novelty_summary(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.novelty_summary(pipeline.scored(spark, folder))


def novelty_failure_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return similarity.failure_reasons(pipeline.scored(spark, folder))


def stored_novelty_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The summary over the scores the items carry, in range."""
    own = pipeline.items(spark, folder).filter("novelty_score between 0 and 100 and not isnan(novelty_score)")
    return similarity.novelty_summary(own.withColumn("novelty_pass", F.col("novelty_score") >= 75))


# --- answers


def json_salvage(spark: SparkSession, folder: str) -> DataFrame:
    """Responses per model by whether an object can be read out of them."""
    r = table(spark, folder, "solver_responses").withColumn("_p", answers.salvage(answers.response_text(F.col("generation"), F.col("response"), F.col("answer"))))
    return r.groupBy("model").agg(F.count(F.lit(1)).alias("responses"), F.count("_p").alias("parsed"))


def graded_attempts(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.graded(spark, folder).select("item_ord", "resp_id", "model", "correct", F.col("parse_error").isNull().alias("parsed"))


def graded_attempts_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every item of more than ten responses taken for hot."""
    out = answers.attempts(pipeline.items(spark, folder), table(spark, folder, "solver_responses"), hot_rows=10)
    return out.select("item_ord", "resp_id", "model", "correct", F.col("parse_error").isNull().alias("parsed"))


def predicted_answers(spark: SparkSession, folder: str) -> DataFrame:
    g = pipeline.graded(spark, folder)

    def shown(column: str):
        return F.array_join(F.transform(column, lambda a: F.concat(F.coalesce(a["blank"], F.lit("-")), F.lit(":"), F.array_join(a["labels"], "+"))), ";")

    return g.groupBy(shown("expected").alias("expected"), shown("predicted").alias("predicted"), "correct").agg(F.count(F.lit(1)).alias("attempts"))


def solver_results(spark: SparkSession, folder: str) -> DataFrame:
    """Items with their graded attempts in order, as attached to them."""
    out = answers.attach_results(pipeline.items(spark, folder), pipeline.graded(spark, folder))
    said = F.transform("solver_results", lambda r: F.concat_ws(",", F.coalesce(r["model"], F.lit("None")), r["correct"].cast("string"), r["parse_error"].isNull().cast("string"), F.md5(r["raw_response"].cast("binary")), F.array_join(F.coalesce(r["missing_blanks"], V.texts()), "+", "-")))
    return out.select("item_ord", "n_attempts", "solver_accuracy", F.md5(F.array_join(said, ";").cast("binary")).alias("results"))


def result_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The same attempts in arrays of about 100: as many in all as there are attempts, none of an item twice."""
    chunks = answers.result_chunks(pipeline.graded(spark, folder), 100)
    return chunks.groupBy("item_ord").agg(F.sum(F.size("solver_results")).alias("attempts"), F.sum(F.size(F.filter("solver_results", lambda r: r["correct"]))).alias("correct"))


def item_accuracies(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.accuracies(spark, folder)


def solver_model_totals(spark: SparkSession, folder: str) -> DataFrame:
    return answers.model_totals(pipeline.graded(spark, folder))


def solver_overall(spark: SparkSession, folder: str) -> DataFrame:
    return answers.solver_summary(pipeline.accuracies(spark, folder))


def orphan_responses(spark: SparkSession, folder: str) -> DataFrame:
    return answers.unknown_responses(pipeline.items(spark, folder), table(spark, folder, "solver_responses")).select("resp_id", "item_id")


def response_rows_invalid(spark: SparkSession, folder: str) -> DataFrame:
    """Responses without item, model or any answer, by what they lack; nulls are absent keys."""
    r = table(spark, folder, "solver_responses").select("resp_id", F.parse_json(F.to_json(F.struct("item_id", "model", "generation", "response", "answer"))).alias("record"))
    return r.select("resp_id", jsonl.response_errors(F.col("record")).alias("problem")).filter("problem is not null")


# --- generations


def generation_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    parsed = generation.parse_generations(table(spark, folder, "raw_generations"))
    return parsed.groupBy("model_name").agg(F.count(F.lit(1)).alias("generations"), F.count("items").alias("with_items"), F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("n_items"))


def failed_generations(spark: SparkSession, folder: str) -> DataFrame:
    parsed = generation.parse_generations(table(spark, folder, "raw_generations"))
    return generation.failed_generations(parsed).groupBy("model_name").agg(F.count(F.lit(1)).alias("failed"))


def explode_generated_items(spark: SparkSession, folder: str) -> DataFrame:
    parsed = generation.parse_generations(table(spark, folder, "raw_generations"))
    rows = generation.explode_items(parsed, "v1")
    names = ["id", "source_seed_id", "generation_model", "question_type"]
    return rows.select("gen_id", "pos", *[V.text(F.try_element_at("item", F.lit(n))).alias(n) for n in names])


def redacted_items(spark: SparkSession, folder: str) -> DataFrame:
    """What of each record stays: its keys, and whether any group still tells its answer."""
    records = pipeline.line_records(spark, folder).withColumn("_r", generation.redacted(F.col("record")))
    leaks = F.exists(V.list_of(F.try_element_at("_r", F.lit("answer_groups"))), lambda g: V.key(g, "correct_labels").isNotNull())
    return records.select("line_no", F.array_join(F.array_sort(F.map_keys("_r")), ",").alias("keys"), leaks.alias("leaks"))


def rendered_prompts(spark: SparkSession, folder: str) -> DataFrame:
    s = pipeline.seeds(spark, folder)
    record = F.to_json(F.struct("seed_id", "question_type", "source_question", "source_answer"))
    prompt = generation.render("Write {{ITEMS_PER_SEED}} items from: {{SEED_JSON}}", ITEMS_PER_SEED=F.lit("2"), SEED_JSON=record)
    return s.select("seed_id", F.md5(prompt.cast("binary")).alias("prompt"), F.length(prompt).alias("n_chars"))


# --- judging


def judge_gate(spark: SparkSession, folder: str) -> DataFrame:
    i = pipeline.items(spark, folder)
    return i.groupBy("question_type").agg(F.count(F.lit(1)).alias("items"), F.count("judge").alias("judged"), F.count_if(judging.typed_accepts(F.col("judge"))).alias("accepted"))


def judged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The accept gate on raw verdicts."""
    r = pipeline.line_records(spark, folder)
    judge = V.key(F.col("record"), "judge")
    return r.select("line_no", judging.accepts(judge).alias("accepted"), V.is_object(judge).alias("judged"))


def judge_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Judge outputs (the stored verdicts as text; prose where there is none) with the item they are about and the decision."""
    i = pipeline.items(spark, folder)
    sent = i.select(answers.item_key(F.col("id"), F.col("item_ord")).alias("item_id"), F.coalesce(F.concat(F.lit("Verdict: "), F.to_json("judge")), F.lit("no verdict")).alias("generation"))
    out = judging.review(sent, i.select("item_ord", "id", "question_type"))
    score = V.number(V.key(F.col("judge"), "score")).cast("int")
    return out.groupBy("item_id", "item.item_ord", "item.question_type").agg(F.count(F.lit(1)).alias("reviews"), F.count_if(judging.accepts(F.col("judge"))).alias("accepted"), F.min(score).alias("least_score"), F.count_if(V.text(V.key(F.col("judge"), "reason")) == "no verdict").alias("failed"))


def seed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    numbered = similarity.number_rows(pipeline.seeds(spark, folder), ["seed_id", "source_question"])
    joined = judging.with_seed(pipeline.items(spark, folder), judging.seed_map(numbered))
    return joined.groupBy("source_seed_id").agg(F.count(F.lit(1)).alias("items"), F.max("seed.source_answer").alias("source_answer"))


# --- rules and selection


def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_counts(pipeline.line_records(spark, folder))


def line_errors(spark: SparkSession, folder: str) -> DataFrame:
    r = pipeline.line_records(spark, folder)
    return r.select("line_no", F.explode(rules.error_texts(F.col("rule_errors"), F.col("line_no"))).alias("error"))


def validation_totals(spark: SparkSession, folder: str) -> DataFrame:
    return rules.validation_totals(pipeline.line_records(spark, folder))


def item_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_counts(rules.item_errors(pipeline.items(spark, folder)))


def gate_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Items per gate issue, without the rules."""
    e = selection.evaluate(pipeline.items(spark, folder), V.texts(), STRICT)
    return e.select(F.explode("filter_issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("items"))


def gate_issues_full(spark: SparkSession, folder: str) -> DataFrame:
    """Items per gate issue with all gates: rules, and a failed novelty gate with its reasons."""
    i = rules.item_errors(pipeline.items(spark, folder))
    reasons = F.when(F.col("item_ord") % 2 == 0, F.array(F.lit("copied"), F.lit("reused"))).otherwise(V.texts())
    i = i.withColumns({"novelty_pass": F.col("novelty_score") >= 75, "novelty_reasons": reasons})
    e = selection.evaluate(i, F.transform("rule_errors", lambda x: x["message"]), STRICT)
    return e.select(F.explode("filter_issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("items"))


def hardness_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Place of each item that passes the gates (rules aside)."""
    e = selection.evaluate(pipeline.items(spark, folder), V.texts(), GATES).filter("size(filter_issues) = 0")
    return selection.ranked(e).select("item_ord", "rank")


def prefix_mean_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    """Fates under an accuracy target and no cap."""
    e = selection.evaluate(pipeline.items(spark, folder), V.texts(), STRICT)
    return selection.select(e, STRICT).select("item_ord", "fate")


def selected_items(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.selected(spark, folder, CAPPED).groupBy("fate").agg(F.count(F.lit(1)).alias("items"))


def filter_summary(spark: SparkSession, folder: str) -> DataFrame:
    return selection.selection_summary(pipeline.selected(spark, folder, STRICT), STRICT)


def rejection_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return selection.rejection_reasons(pipeline.selected(spark, folder, STRICT))


def hardest_accepted(spark: SparkSession, folder: str) -> DataFrame:
    """A top-k report: the cap is the feature."""
    return pipeline.selected(spark, folder, CAPPED).filter("fate = 'accepted'").select("item_ord", "rank")


# --- audits


def type_quota(spark: SparkSession, folder: str) -> DataFrame:
    return audit.quota(pipeline.items(spark, folder), F.col("question_type"), {"reading_comprehension": 15, "text_completion": 9, "sentence_equivalence": 6})


def profile_quotas(spark: SparkSession, folder: str) -> DataFrame:
    return audit.profile_quotas(pipeline.items(spark, folder))


def passage_set_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Sets of five questions on the same passages."""
    return audit.set_sizes(pipeline.items(spark, folder), "passage_set_id", F.to_json("passages"), 5)


def hard_share(spark: SparkSession, folder: str) -> DataFrame:
    """Whether three items in ten are hard."""
    return audit.share_of(pipeline.items(spark, folder), F.col("difficulty") >= 4, 0.3)


def answer_gap(spark: SparkSession, folder: str) -> DataFrame:
    return audit.balance_gap(pipeline.items(spark, folder))


def numbered_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that the range gre-tc-000000001 to gre-tc-000000500 lacks."""
    return audit.numbering(pipeline.items(spark, folder), "gre-tc-", 9, 500)


def passage_sets(spark: SparkSession, folder: str) -> DataFrame:
    return audit.set_sizes(pipeline.items(spark, folder), "passage_id", F.col("passage"), 3)


def choice_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.choice_counts(pipeline.items(spark, folder))


def identifier_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.identifiers(pipeline.items(spark, folder), "^(gre|lsat)-(tc|se|rc|lr)-[0-9]{9}$")


def field_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.field_rules(pipeline.items(spark, folder))


def passage_words(spark: SparkSession, folder: str) -> DataFrame:
    i = pipeline.items(spark, folder)
    return audit.word_range(i.select(F.explode(X.passage_texts(F.col("passage"), F.col("passages"))).alias("text")), F.col("text"), 60, 160)


def passage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.passage_counts(pipeline.items(spark, folder))


def answer_balance(spark: SparkSession, folder: str) -> DataFrame:
    return audit.label_balance(pipeline.items(spark, folder))


def score_scale(spark: SparkSession, folder: str) -> DataFrame:
    return audit.scores_in_scale(pipeline.items(spark, folder), F.col("judge.score"))


def answer_contract(spark: SparkSession, folder: str) -> DataFrame:
    return audit.answer_contract(pipeline.graded(spark, folder))


def items_per_generation(spark: SparkSession, folder: str) -> DataFrame:
    return audit.items_per_generation(generation.parse_generations(table(spark, folder, "raw_generations")), 2)


def repeated_across_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Stems that occur in several batches of ten items."""
    out = audit.repeated_across(pipeline.items(spark, folder), F.floor(F.col("item_ord") / 10), F.col("stem"))
    return out.groupBy("batches").agg(F.count(F.lit(1)).alias("texts"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [
        p3_found, p3_choices, jsonl_scan, record_identifiers, answer_key_flatten, normalized_texts, content_token_stats, abstract_structures,
        seed_choices, distinctive_terms, main_texts, novelty_lexical_riskiest, own_seed_similarity, own_seed_phrases, novelty_full, novelty_summary,
        novelty_failure_reasons, stored_novelty_summary, json_salvage, graded_attempts, graded_attempts_salted, predicted_answers, item_accuracies, solver_model_totals,
        solver_overall, orphan_responses, response_rows_invalid, generation_outcomes, failed_generations, explode_generated_items, redacted_items,
        rendered_prompts, judge_gate, judged_lines, seed_lookup, rule_counts, line_errors, validation_totals, item_rule_counts, gate_issues,
        hardness_ranks, prefix_mean_cutoff, selected_items, filter_summary, rejection_histogram, hardest_accepted, type_quota, passage_sets,
        choice_counts, identifier_audit, field_audit, passage_words, passage_counts, answer_balance, score_scale, answer_contract,
        items_per_generation, repeated_across_batches, novelty_sets, line_texts, line_novelty, solver_results, result_chunks, judge_reviews, gate_issues_full,
        profile_quotas, passage_set_sizes, hard_share, answer_gap, numbered_identifiers,
    ]
    return {f.__name__: f for f in every}
