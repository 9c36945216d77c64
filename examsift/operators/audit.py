"""Audits of whole datasets: counts against quotas, shared passages, identifiers, ranges, balance.

Each audit is one aggregation (combined before its shuffle) whose rows say what was expected, what was
found and whether it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.functions import text as X


def quota(df: DataFrame, key: Column, expected: dict[str, int]) -> DataFrame:
    """(value, expected, found, holds): rows per value against a quota; values on one side only are listed too."""
    wanted = df.sparkSession.createDataFrame(sorted(expected.items()) or [], "value string, expected bigint")
    found = df.groupBy(key.cast("string").alias("value")).agg(F.count(F.lit(1)).alias("found"))
    both = found.join(wanted, "value", "full")
    counts = both.select("value", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("found", F.lit(0)).alias("found"))
    return counts.withColumn("holds", F.col("expected") == F.col("found"))


# Profiles of whole sets, each a column of items and the number of items per value.
PROFILES = {
    "verbal set of 30": ("question_type", {"reading_comprehension": 15, "text_completion": 9, "sentence_equivalence": 6}),
    "verbal reading": ("subtype", {"select_one": 10, "select_one_or_more": 3, "select_sentence": 2}),
    "verbal completion": ("subtype", {"one_blank": 3, "two_blank": 3, "three_blank": 3}),
    "law set of 30": ("question_type", {"logical_reasoning": 20, "reading_comprehension": 10}),
    "law reasoning": ("subtype", {"strengthen": 4, "weaken": 4, "necessary_assumption": 3, "flaw": 3, "inference": 2, "method_of_reasoning": 2, "parallel_reasoning": 2}),
    "law paper": ("question_type", {"logical_reasoning": 40, "reading_comprehension": 20}),
    "management paper": ("section", {"quantitative": 21, "verbal": 23, "data insights": 20}),
    "cognitive test": ("section", {"section 1": 10, "section 2": 10, "section 3": 10, "section 4": 10, "section 5": 10, "section 6": 10}),
}


def profile_quotas(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(profile, value, expected, found, holds): the values each profile asks for; a column that items lack holds nothing."""
    out = None
    for name in names or PROFILES:
        column, expected = PROFILES[name]
        key = F.col(column) if column in df.columns else F.lit(None).cast("string")
        rows = quota(df, key, expected).filter("expected > 0").select(F.lit(name).alias("profile"), "value", "expected", "found", "holds")
        out = rows if out is None else out.unionByName(rows)
    return out


def set_sizes(df: DataFrame, set_id: str, texts: Column, size: int) -> DataFrame:
    """(``set_id``, questions, texts, holds): sets of items that share a passage have ``size`` items and one text.

    Hashes of texts are compared, so a set's texts are never gathered. Null set ids are left out.
    """
    rows = df.filter(F.col(set_id).isNotNull()).select(set_id, F.xxhash64(texts).alias("_t"))
    out = rows.groupBy(set_id, "_t").count().groupBy(set_id).agg(F.sum("count").alias("questions"), F.count(F.lit(1)).alias("texts"))
    return out.withColumn("holds", (F.col("questions") == size) & (F.col("texts") == 1))


def choice_counts(df: DataFrame) -> DataFrame:
    """(question_type, subtype, choices, correct, groups): how many groups have so many choices and correct labels."""
    groups = df.select("question_type", "subtype", F.explode("answer_groups").alias("g"))
    sized = groups.select("question_type", "subtype", F.coalesce(F.size("g.choices"), F.lit(0)).alias("choices"), F.coalesce(F.size("g.correct_labels"), F.lit(0)).alias("correct"))
    return sized.groupBy("question_type", "subtype", "choices", "correct").agg(F.count(F.lit(1)).alias("groups"))


def identifiers(df: DataFrame, pattern: str) -> DataFrame:
    """One row: items, missing ids, ids that do not fit ``pattern``, ids that occur more than once."""
    ids = df.groupBy(F.nullif("id", F.lit("")).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("items"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(known & ~F.col("id").rlike(pattern)).alias("malformed"),
        F.count_if(known & (F.col("n") > 1)).alias("repeated"),
    )


def numbering(df: DataFrame, prefix: str, width: int, count: int) -> DataFrame:
    """Ids that a numbered range <prefix><zero-padded number> of ``count`` items lacks."""
    wanted = df.sparkSession.range(1, count + 1).select(F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), width, "0")).alias("id"))
    return wanted.join(df.select("id").distinct(), "id", "left_anti")


def field_rules(df: DataFrame) -> DataFrame:
    """(rule, broken): difficulty within 1..5, two to five lower-case tags, a passage on reading items and only there."""
    reading = F.col("question_type") == "reading_comprehension"
    any_passage = F.coalesce(X.squeeze(F.col("passage")) != "", F.lit(False)) | F.coalesce(F.size("passages") > 0, F.lit(False))
    tags = F.coalesce("skill_tags", F.array().cast("array<string>"))
    rules = {
        "difficulty 1 to 5": ~F.coalesce(F.col("difficulty").between(1, 5), F.lit(False)),
        "two to five tags": ~F.size(tags).between(2, 5),
        "tags in lower case": F.exists(tags, lambda t: F.coalesce(t != F.lower(t), F.lit(False))),
        "passage on reading items only": F.coalesce(reading, F.lit(False)) != any_passage,
    }
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "broken")


def word_range(df: DataFrame, text: Column, least: int, most: int) -> DataFrame:
    """One row: texts, those with fewer than ``least`` words and those with more than ``most``; blank and null texts are not counted."""
    words = F.when(X.squeeze(text) != "", F.size(F.split(X.squeeze(text), " ")))
    return df.agg(F.count(words).alias("texts"), F.count_if(words < least).alias("short"), F.count_if(words > most).alias("long"))


def passage_counts(df: DataFrame) -> DataFrame:
    """(subtype, passages, items) of items with a list of passages."""
    return df.filter("passages is not null").groupBy("subtype", F.size("passages").alias("passages")).agg(F.count(F.lit(1)).alias("items"))


def label_balance(df: DataFrame, only_single: bool = True) -> DataFrame:
    """(label, answers, share): how often each label is correct; with ``only_single`` in groups with one correct label."""
    groups = df.select(F.explode("answer_groups").alias("g"))
    kept = groups.filter(F.size("g.correct_labels") == 1) if only_single else groups
    labels = kept.select(F.explode("g.correct_labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("answers"))
    total = labels.agg(F.sum("answers")).first()[0] or 0
    return labels.withColumn("share", F.round(F.col("answers") / F.lit(float(max(1, total))), 6))


def balance_gap(df: DataFrame) -> DataFrame:
    """One row: the largest difference between shares of labels."""
    return label_balance(df).agg((F.max("share") - F.min("share")).alias("gap"))


def flags_all_true(flags: Column) -> Column:
    """All values of a MAP<STRING, BOOLEAN> are true; null and empty maps fail."""
    return F.coalesce((F.size(flags) > 0) & F.forall(F.map_values(flags), lambda x: x.eqNullSafe(True)), F.lit(False))


def share_of(df: DataFrame, flag: Column, least: float) -> DataFrame:
    """One row: rows, share with the flag, and whether it reaches ``least``; null share without rows."""
    share = F.avg(F.coalesce(flag, F.lit(False)).cast("int"))
    return df.agg(F.count(F.lit(1)).alias("rows"), share.alias("share"), F.coalesce(share >= least, F.lit(False)).alias("holds"))


def scores_in_scale(df: DataFrame, score: Column, least: int = 1, most: int = 5) -> DataFrame:
    """(score, items, in_scale) over judged items."""
    return df.filter(score.isNotNull()).groupBy(score.alias("score")).agg(F.count(F.lit(1)).alias("items")).withColumn("in_scale", F.col("score").between(least, most))


def answer_contract(graded: DataFrame) -> DataFrame:
    """(attempts, wrong_count, many_labels): attempts that answer another number of blanks than asked, or give a blank
    more labels than it has correct ones. Unparsed attempts are left out."""
    parsed = graded.filter(F.col("parse_error").isNull())
    more = F.exists("predicted", lambda p: F.size(p["labels"]) > F.array_max(F.transform("expected", lambda e: F.size(e["labels"]))))
    return parsed.agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.size("predicted") != F.size("expected")).alias("wrong_count"), F.count_if(F.coalesce(more, F.lit(False))).alias("many_labels"))


def items_per_generation(parsed: DataFrame, wanted: int) -> DataFrame:
    """(items, generations, holds): generations by their number of items."""
    ok = parsed.filter("error is null")
    return ok.groupBy(F.size("items").alias("items")).agg(F.count(F.lit(1)).alias("generations")).withColumn("holds", F.col("items") == wanted)


def repeated_across(df: DataFrame, batch: Column, text: Column) -> DataFrame:
    """(form, batches): texts that occur in more than one batch, by the hash of their match form."""
    rows = df.select(batch.alias("_b"), F.xxhash64(X.match_form(text)).alias("form")).distinct()
    return rows.groupBy("form").agg(F.count(F.lit(1)).alias("batches")).filter("batches > 1")
