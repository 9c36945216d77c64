"""Queries of the problems solved here, and their SQL where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examsift.llm import copies, leakage, mixing, near_duplicates, rank_walk, repetition, sampling, tokenizing, truncation
from examsift.runtime import work_table as table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    records = leakage.corpus_records(table(spark, folder, "generated_items"), table(spark, folder, "documents"))
    return leakage.find_leaks(records, leakage.held_out_passages(table(spark, folder, "seed_records")))


def p1_items_leaked(spark: SparkSession, folder: str) -> DataFrame:
    """Which held-out seeds leaked, and into how many records of each corpus."""
    return p1_found(spark, folder).groupBy("seed_id", "corpus").agg(F.count(F.lit(1)).alias("records"))


def p2_order(spark: SparkSession, folder: str) -> DataFrame:
    return rank_walk.rank_walk(table(spark, folder, "generated_items"), rank_walk.item_scores())


def p2_by_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """The same walk with a job per step, as for very many states; to six places."""
    walked = rank_walk.rank_walk(table(spark, folder, "generated_items"), rank_walk.item_scores(), driver_states=0, tolerance=1e-12)
    return walked.select("item_ord", F.round("stationarity", 6).alias("stationarity"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.similar_items(table(spark, folder, "generated_items"))


def p4_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Each item with the class of its copies, its group of near duplicates and the number of items it is linked to."""
    return near_duplicates.item_groups(table(spark, folder, "generated_items"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.unmet_cells(table(spark, folder, "generated_items"), table(spark, folder, "sample_targets"))


def p5_plan(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.sample_plan(table(spark, folder, "generated_items"), table(spark, folder, "sample_targets"))


def p5_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row: cells, those short of rows and of room, rows planned, and the deviation from the targets that is left."""
    plan = sampling.sample_plan(table(spark, folder, "generated_items"), table(spark, folder, "sample_targets"))
    return plan.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("short") == "rows").alias("short_of_rows"), F.count_if(F.col("short") == "size").alias("short_of_size"),
        F.sum("wanted").alias("wanted"), F.sum("planned").alias("planned"), F.sum(F.abs(F.col("planned") - F.greatest("wanted", "min_rows"))).alias("deviation"),
    )


def p5_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Per cell of the plan: whether its sample holds the rows planned, and no row twice."""
    plan = sampling.sample_plan(table(spark, folder, "generated_items"), table(spark, folder, "sample_targets"))
    drawn = p5_sample(spark, folder).groupBy(*sampling.CELL).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_ord").alias("items"))
    both = plan.join(drawn, sampling.CELL, "left")
    holds = (F.coalesce("n", F.lit(0)) == F.col("planned")) & (F.coalesce("n", F.lit(0)) == F.coalesce("items", F.lit(0)))
    return both.select(*sampling.CELL, "available", "wanted", "met", "short", holds.alias("holds"))


def p5_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.draw_sample(table(spark, folder, "generated_items"), table(spark, folder, "sample_targets"))


def _generated(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.generated_texts(table(spark, folder, "raw_generations"), table(spark, folder, "solver_responses"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncated_rows(_generated(spark, folder))


def p6_rates(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.truncation_rates(_generated(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.hidden_copies(table(spark, folder, "generated_items"))


def p7_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapsed_items(table(spark, folder, "generated_items"))


def p7_salted(spark: SparkSession, folder: str) -> DataFrame:
    """p7_found with every content of two rows or more taken for hot: salted, on two levels, joined back by broadcast."""
    return copies.hidden_copies(table(spark, folder, "generated_items"), hot_rows=1)


def p7_collapsed_salted(spark: SparkSession, folder: str) -> DataFrame:
    return copies.collapsed_items(table(spark, folder, "generated_items"), hot_rows=1)


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenizing.encode_corpus(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p8_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Every document whose decoded ids differ from its text: none."""
    ids = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = ids.withColumn("back", tokenizing.decoded(tokenizing.token_ids(F.col("text"))))
    return back.filter(F.col("back") != F.col("text")).select("doc_id")


def p8_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Where the tokens of each document start and end, and whether they follow one another without a gap, one per id."""
    d = table(spark, folder, "documents").select("doc_id", "text")
    d = d.withColumns({"_t": tokenizing.token_offsets(F.col("text")), "_n": tokenizing.token_count(F.col("text"))})
    gap = F.exists(F.sequence(F.lit(1), F.greatest(F.size("_t"), F.lit(1))), lambda i: F.coalesce(F.try_element_at("_t", i + 1)["start"] > F.try_element_at("_t", i)["end"], F.lit(False)))
    return d.select("doc_id", F.try_element_at("_t", F.lit(1))["start"].alias("first"), F.try_element_at("_t", F.lit(-1))["end"].alias("last"), (~gap & (F.size("_t") == F.col("_n"))).alias("whole"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.unmet_sources(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares_reached(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Per target: each document is emitted floor(rate) or one more times, within the repeats allowed, and the tokens emitted are
    as many as the rate promises, give or take six standard deviations of the draw."""
    documents, targets = table(spark, folder, "documents"), table(spark, folder, "mix_targets")
    sizes = mixing.document_sizes(documents)
    rates = mixing.source_rates(sizes, targets)
    sent = mixing.emitted(sizes, rates, 7).select("source", "copies", "n_tokens", "rate")
    part = F.col("rate") - F.floor("rate")
    per = sent.groupBy("source").agg(
        F.min(F.col("copies") - F.floor("rate")).alias("_least"), F.max(F.col("copies") - F.floor("rate")).alias("_most"), F.max("copies").alias("_copies"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("_sent"), F.sum(F.col("rate") * F.col("n_tokens")).alias("_due"), F.sqrt(F.sum(part * (1 - part) * F.col("n_tokens") * F.col("n_tokens"))).alias("_sd"),
    )
    both = rates.join(per, "source", "left")
    draws = F.coalesce(F.col("_least").between(0, 1) & F.col("_most").between(0, 1) & (F.col("_copies") <= F.col("max_repeats")), F.lit(True))
    total = F.coalesce(F.abs(F.col("_sent") - F.col("_due")) <= 6 * F.col("_sd") + 1, F.lit(True))
    return both.select("source", "target_share", "max_repeats", draws.alias("draws_hold"), total.alias("tokens_hold"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repetitive_documents(table(spark, folder, "documents"))


def p10_shares(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.repeated_share(table(spark, folder, "documents"))


def p10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.clean_lines(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = [p1_found, p1_items_leaked, p2_order, p2_by_tasks, p4_found, p4_groups, p5_found, p5_plan, p5_totals, p5_cells, p5_sample, p6_found, p6_rates, p7_found, p7_collapsed, p7_salted, p7_collapsed_salted, p8_ids, p8_round_trip, p8_spans, p9_found, p9_mixture, p9_shares, p9_checks, p10_found, p10_shares, p10_lines]
    return {f.__name__: f for f in every}


_P5_CELLS = """
WITH t AS (SELECT regexp_replace(regexp_replace(lower(question_type), '^\\s+|\\s+$', '', 'g'), '[\\s\\-]+', '_', 'g') AS question_type,
                  regexp_replace(regexp_replace(lower(subtype), '^\\s+|\\s+$', '', 'g'), '[\\s\\-]+', '_', 'g') AS subtype,
                  difficulty, target_bp, min_rows FROM sample_targets),
     i AS (SELECT regexp_replace(regexp_replace(lower(question_type), '^\\s+|\\s+$', '', 'g'), '[\\s\\-]+', '_', 'g') AS question_type,
                  regexp_replace(regexp_replace(lower(subtype), '^\\s+|\\s+$', '', 'g'), '[\\s\\-]+', '_', 'g') AS subtype,
                  difficulty, count(*) AS n FROM generated_items GROUP BY ALL),
     s AS (SELECT count(*) // 5 AS n FROM generated_items)
"""

# floors that exceed the sample are shared out by largest remainders; otherwise every cell gets what is due, as far as it has it
_P5_PLAN = _P5_CELLS + """, a AS (SELECT t.*, coalesce(i.n, 0) AS available, target_bp * s.n // 10000 AS wanted, greatest(min_rows, target_bp * s.n // 10000) AS due, least(min_rows, coalesce(i.n, 0)) AS held, s.n AS size,
    sum(least(min_rows, coalesce(i.n, 0))) OVER () AS floors FROM t CROSS JOIN s LEFT JOIN i USING (question_type, subtype, difficulty)),
h AS (SELECT *, row_number() OVER (ORDER BY held * size % greatest(floors, 1) DESC, question_type, subtype, difficulty) <= size - sum(held * size // greatest(floors, 1)) OVER () AS more FROM a),
k AS (SELECT *, held * size // greatest(floors, 1) + more::INT AS share FROM h),
m AS (SELECT *, CASE WHEN available < due THEN 'rows' WHEN floors > size AND share < due THEN 'size' END AS short FROM k)
"""

_P4_PAIRS = """
t AS (SELECT item_ord, list_filter(regexp_split_to_array(lower(concat(coalesce(stem, ''), ' ', coalesce(stimulus, ''), ' ', coalesce(explanation, ''))), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM generated_items),
     g AS (SELECT DISTINCT item_ord, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS gram FROM t WHERE len(w) >= 3),
     n AS (SELECT item_ord, count(*) AS n FROM g GROUP BY 1),
     c AS (SELECT a.item_ord AS item_a, b.item_ord AS item_b, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.item_ord < b.item_ord GROUP BY 1, 2),
     pairs AS (SELECT item_a, item_b FROM c JOIN n x ON x.item_ord = item_a JOIN n y ON y.item_ord = item_b WHERE common * 100 >= 60 * (x.n + y.n - common))"""

# Each step of the walk as windows over the states: what reaches an item from lower values is a running sum.
_P2_WALK = """
WITH RECURSIVE sc AS (SELECT item_ord, CASE WHEN NOT isnan(novelty_score) AND novelty_score BETWEEN 0 AND 100 THEN novelty_score END AS a, CASE WHEN NOT isnan(solver_accuracy) AND solver_accuracy BETWEEN 0 AND 1 THEN -solver_accuracy END AS b,
  CASE WHEN difficulty BETWEEN 1 AND 5 THEN difficulty::DOUBLE END AS c FROM generated_items),
g AS (SELECT a, b, c, count(*)::DOUBLE AS n FROM sc GROUP BY ALL),
st AS (SELECT *, row_number() OVER () AS s, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS own, sum(n) OVER () AS items,
  sum(n) FILTER (a IS NOT NULL) OVER () - sum(n) FILTER (a IS NOT NULL) OVER (ORDER BY a RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_a,
  sum(n) FILTER (b IS NOT NULL) OVER () - sum(n) FILTER (b IS NOT NULL) OVER (ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_b,
  sum(n) FILTER (c IS NOT NULL) OVER () - sum(n) FILTER (c IS NOT NULL) OVER (ORDER BY c RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up_c FROM g),
walk AS (SELECT 0 AS step, s, n / items AS mass FROM st
UNION ALL SELECT step + 1, s, 0.85::DOUBLE * (stay + n * (CASE WHEN a IS NULL THEN 0 ELSE ra - pa END + CASE WHEN b IS NULL THEN 0 ELSE rb - pb END + CASE WHEN c IS NULL THEN 0 ELSE rc - pc END + lost / items)) + 0.15::DOUBLE * n / items FROM (
  SELECT *, CASE WHEN a IS NOT NULL AND up_a = 0 THEN f ELSE 0 END + CASE WHEN b IS NOT NULL AND up_b = 0 THEN f ELSE 0 END + CASE WHEN c IS NOT NULL AND up_c = 0 THEN f ELSE 0 END AS stay, sum(CASE WHEN own = 0 THEN mass ELSE 0 END) OVER () AS lost,
    sum(fa) OVER (ORDER BY a RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ra, sum(fa) OVER (PARTITION BY a) AS pa, sum(fb) OVER (ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rb, sum(fb) OVER (PARTITION BY b) AS pb,
    sum(fc) OVER (ORDER BY c RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rc, sum(fc) OVER (PARTITION BY c) AS pc FROM (
    SELECT step, mass, st.*, mass / greatest(own, 1) AS f, CASE WHEN a IS NOT NULL AND up_a > 0 THEN mass / own / up_a ELSE 0 END AS fa, CASE WHEN b IS NOT NULL AND up_b > 0 THEN mass / own / up_b ELSE 0 END AS fb, CASE WHEN c IS NOT NULL AND up_c > 0 THEN mass / own / up_c ELSE 0 END AS fc
    FROM walk JOIN st USING (s) WHERE step < 250))),
w AS (SELECT a, b, c, n, round(mass / n * items, 9) AS stationarity, round(mass / n * items, 6) AS rounded FROM walk JOIN st USING (s) WHERE step = 250),
r AS (SELECT *, (coalesce(sum(n) OVER (ORDER BY stationarity DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(n) OVER (PARTITION BY stationarity), 0) + 1)::BIGINT AS rank FROM w)
"""

_ITEM_FORM = """
WITH k AS (SELECT item_ord,
  regexp_replace(lower(coalesce(stem, '')), '[^\\p{L}\\p{N}]+', '', 'g') AS stem_form,
  list_sort(list_transform(coalesce(flatten(list_transform(answer_groups, lambda g: coalesce(g.choices, []))), []),
            lambda c: regexp_replace(lower(coalesce(c.text, '')), '[^\\p{L}\\p{N}]+', '', 'g'))) AS choice_forms
  FROM generated_items)
"""


def _re(pattern: str) -> str:
    """A Python pattern in RE2's terms (letters and digits are Unicode's), as a SQL string."""
    word, space = "\\p{L}\\p{N}_", "\\s\\x0b\\x1c-\\x1f\\x85\\p{Z}"
    out = pattern.replace("[\\W_]", "[^\\p{L}\\p{N}]").replace("[\\w ", f"[{word} ").replace("\\w", f"[{word}]").replace("\\W", f"[^{word}]").replace("\\s", f"[{space}]").replace("\\d", "\\p{Nd}").replace("\\u2028\\u2029", "\\x{2028}\\x{2029}")
    return out.replace("'", "''")


_LINES = ", ".join(f"regexp_full_match(line, '{'(?i)' if r.flags & re.I else ''}{_re(r.pattern)}') AS {n}" for n, r in repetition.LINE_RULES.items())
_P10_LINES = f"""
WITH l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS k, unnest(ls) AS line FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '{_re(repetition.BREAK.pattern)}') AS ls FROM documents)),
w AS (SELECT doc_id, k, line, list_filter(regexp_split_to_array(lower(line), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS own, {_LINES} FROM l),
p AS (SELECT *, coalesce(sum(len(own)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM w),
t AS (SELECT doc_id, flatten(list(own ORDER BY k)) AS w FROM w GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS nth FROM g) WHERE nth > 1),
c AS (SELECT DISTINCT doc_id, i + j AS pos FROM r CROSS JOIN (SELECT unnest(range(0, 5)) AS j)),
n AS (SELECT p.doc_id, k, count(*) AS repeated FROM p JOIN c ON c.doc_id = p.doc_id AND pos > before AND pos <= before + len(own) GROUP BY ALL),
v AS (SELECT p.*, coalesce(repeated, 0) AS repeated, CASE WHEN regexp_full_match(line, '{_re(chr(92) + "s*")}') THEN 'blank' WHEN punctuation THEN 'punctuation' WHEN navigation THEN 'navigation' WHEN boilerplate THEN 'boilerplate' WHEN repeated > 0 THEN 'repetition' END AS failed
      FROM p LEFT JOIN n USING (doc_id, k)),
d AS (SELECT doc_id, count(*) FILTER (failed IS DISTINCT FROM 'blank') AS n_lines, sum(len(own))::BIGINT AS n_words, sum(repeated)::BIGINT AS n_repeated, count(*) FILTER (failed = 'punctuation') AS by_punctuation, count(*) FILTER (failed = 'navigation') AS by_navigation,
      count(*) FILTER (failed = 'boilerplate') AS by_boilerplate, count(*) FILTER (failed = 'repetition') AS by_repetition, coalesce(sum(len(own)) FILTER (failed <> 'blank'), 0)::BIGINT AS words_lost,
      coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (failed IS NULL OR failed = 'blank'), '') AS cleaned FROM v GROUP BY doc_id)
SELECT * REPLACE (CASE WHEN NOT (n_words > 0 AND words_lost * 100 >= n_words * 30) THEN cleaned END AS cleaned), n_words > 0 AND words_lost * 100 >= n_words * 30 AS rejected FROM d"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_order": _P2_WALK + "SELECT item_ord, stationarity, rank FROM sc JOIN r ON sc.a IS NOT DISTINCT FROM r.a AND sc.b IS NOT DISTINCT FROM r.b AND sc.c IS NOT DISTINCT FROM r.c",
        "p2_by_tasks": _P2_WALK + "SELECT item_ord, rounded AS stationarity FROM sc JOIN r ON sc.a IS NOT DISTINCT FROM r.a AND sc.b IS NOT DISTINCT FROM r.b AND sc.c IS NOT DISTINCT FROM r.c",
        "p4_found": f"WITH {_P4_PAIRS} SELECT item_a, item_b FROM pairs",
        "p4_groups": f"""WITH RECURSIVE {_P4_PAIRS}, both_ways AS (SELECT item_a AS x, item_b AS y FROM pairs UNION ALL SELECT item_b, item_a FROM pairs),
reach AS (SELECT x, y FROM both_ways UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x),
l AS (SELECT x, count(*) AS links FROM both_ways GROUP BY x), m AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT item_ord, CASE WHEN len(w) > 0 THEN min(item_ord) OVER (PARTITION BY w) ELSE item_ord END AS class, least(item_ord, coalesce(y, item_ord)) AS "group", coalesce(links, 0) AS links
FROM t LEFT JOIN l ON l.x = item_ord LEFT JOIN m ON m.x = item_ord""",
        "p5_found": _P5_CELLS + "SELECT t.question_type, t.subtype, t.difficulty FROM t CROSS JOIN s LEFT JOIN i USING (question_type, subtype, difficulty) WHERE coalesce(i.n, 0) < greatest(min_rows, target_bp * s.n // 10000)",
        "p5_totals": _P5_PLAN + """SELECT count(*) AS cells, count(*) FILTER (short = 'rows') AS short_of_rows, count(*) FILTER (short = 'size') AS short_of_size, sum(wanted)::BIGINT AS wanted, least(max(size), sum(available))::BIGINT AS planned,
  (CASE WHEN max(floors) > max(size) THEN sum(abs(due - share)) ELSE sum(due - least(available, due)) + least(max(size), sum(available)) - sum(least(available, due)) END)::BIGINT AS deviation FROM m""",
        "p5_cells": _P5_PLAN + "SELECT question_type, subtype, difficulty, available, wanted, short IS NULL AS met, short, true AS holds FROM m",
        "p7_found": _ITEM_FORM + "SELECT keep_ord, item_ord FROM (SELECT item_ord, min(item_ord) OVER (PARTITION BY stem_form, choice_forms) AS keep_ord FROM k) WHERE item_ord <> keep_ord",
        "p7_collapsed": _ITEM_FORM + "SELECT min(item_ord) AS item_ord, count(*) AS n_copies FROM k GROUP BY stem_form, choice_forms",
        "p7_salted": _ITEM_FORM + "SELECT keep_ord, item_ord FROM (SELECT item_ord, min(item_ord) OVER (PARTITION BY stem_form, choice_forms) AS keep_ord FROM k) WHERE item_ord <> keep_ord",
        "p7_collapsed_salted": _ITEM_FORM + "SELECT min(item_ord) AS item_ord, count(*) AS n_copies FROM k GROUP BY stem_form, choice_forms",
        "p8_round_trip": "SELECT doc_id FROM documents WHERE false",
        "p8_spans": "SELECT doc_id, CASE WHEN text <> '' THEN 0 END AS first, CASE WHEN text <> '' THEN length(text) END::INT AS last, true AS whole FROM documents",
        "p9_checks": "SELECT source, target_share, max_repeats, true AS draws_hold, true AS tokens_hold FROM mix_targets",
        "p10_lines": _P10_LINES,
        "p10_shares": """
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents),
     g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
     r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS nth FROM g) WHERE nth > 1),
     c AS (SELECT doc_id, count(DISTINCT i + k) AS covered FROM r CROSS JOIN (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(covered, 0) AS n_repeated, coalesce(coalesce(covered, 0) / nullif(len(w), 0), 0.0) AS repeated_share FROM t LEFT JOIN c USING (doc_id)""",
        "p10_found": """
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents),
     g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 10)),
     r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) AS nth FROM g) WHERE nth > 1),
     c AS (SELECT doc_id, count(DISTINCT i + k) AS covered FROM r CROSS JOIN (SELECT unnest(range(0, 5)) AS k) GROUP BY doc_id)
SELECT doc_id FROM c JOIN t USING (doc_id) WHERE covered * 100 >= 30 * len(w)""",
    }
