"""Similarity of items to a set of sources, and the riskiest source of each item.

Features of items and sources are Column expressions, computed once per record. Sources are a stated
query set: their features go to the driver in blocks of bounded size and out to all tasks, and every
item is compared with all of them where it is read. Nothing is shuffled, whatever the number of items.

Set overlaps come from posting lists. The costly sequence ratio of structures is computed only for
sources that could still be the riskiest: an upper bound from lengths and character counts decides, so
the result is the same as that of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.functions import text as X
from examsift.functions import variants as V
from examsift.functions.constants import NEAR_COPY_RATIO, NEAR_COPY_TOKENS, NOVELTY_THRESHOLD, WEIGHTS

#: Sources compared in one pass.
SOURCES_AT_ONCE = 5_000
#: Similarities closer than this may round to the same score.
ROUNDING = 0.0011

FEATURES = ["tokens", "grams3", "grams4", "choices", "terms", "structure"]
COMPONENTS = ["lexical", "phrase", "choice", "entity", "structure"]


# --- set measures as Columns


def jaccard(left: Column, right: Column) -> Column:
    """Common of all distinct elements; 0 if a side is empty."""
    either = F.size(F.array_union(left, right))
    return F.when((F.size(left) > 0) & (F.size(right) > 0), F.size(F.array_intersect(left, right)) / either).otherwise(0.0)


def containment(left: Column, right: Column) -> Column:
    """Common of the distinct elements of the smaller side; 0 if a side is empty."""
    least = F.least(F.size(F.array_distinct(left)), F.size(F.array_distinct(right)))
    return F.when(least > 0, F.size(F.array_intersect(left, right)) / F.greatest(least, F.lit(1))).otherwise(0.0)


def lexical_similarity(left: Column, right: Column) -> Column:
    """Of two arrays of content tokens."""
    return F.least(F.lit(1.0), 0.65 * jaccard(left, right) + 0.35 * containment(left, right))


def phrase_similarity(left: Column, right: Column) -> Column:
    """Of two arrays of content tokens: the best of 3- and 4-grams that both sides have."""
    best = []
    for n in (3, 4):
        a, b = X.ngrams(left, n), X.ngrams(right, n)
        best.append(F.when((F.size(a) > 0) & (F.size(b) > 0), F.greatest(jaccard(a, b), 0.8 * containment(a, b))))
    return F.coalesce(F.greatest(*best), F.lit(0.0))


def entity_reuse(left: Column, right: Column) -> Column:
    """STRUCT<share, terms>: the part of the left terms found on the right, and these terms, sorted."""
    shared = F.array_sort(F.array_intersect(left, right))
    return F.struct(F.when(F.size(left) > 0, F.size(shared) / F.size(left)).otherwise(0.0).alias("share"), shared.alias("terms"))


# --- features


def _with_features(df: DataFrame, keys: list[str]) -> DataFrame:
    """Features from ``_text``, ``_structure`` and ``_choices``; each step is a projection of its own, so shared parts are computed once."""
    worded = df.withColumn("_words", X.content_tokens(F.col("_text")))
    return worded.select(
        *keys,
        F.array_distinct("_words").alias("tokens"),
        X.ngrams(F.col("_words"), 3).alias("grams3"),
        X.ngrams(F.col("_words"), 4).alias("grams4"),
        X.match_choices(F.col("_choices")).alias("choices"),
        X.distinctive_terms(F.col("_text")).alias("terms"),
        X.abstract_structure(F.col("_structure")).alias("structure"),
    )


def item_features(items: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the features of typed items."""
    parts = items.withColumns({"_passages": X.passage_texts(F.col("passage"), F.col("passages")), "_choices": X.choice_texts(F.col("answer_groups"), F.col("stem"))})
    text = X.item_text(F.col("stimulus"), F.col("_passages"), F.col("stem"), F.col("_choices"))
    structure = X.item_structure_text(F.col("stimulus"), F.col("_passages"), F.col("stem"))
    return _with_features(parts.withColumns({"_text": text, "_structure": structure}), keys)


def seed_features(seeds: DataFrame) -> DataFrame:
    """(source_id, ord, features) of seeds, whose question holds body and choices. ``ord`` orders by id and text; a
    seed without id is called source-<ord>."""
    question = F.col("source_question")
    ordered = number_rows(seeds.select("seed_id", "source_question"), ["seed_id", "source_question"])
    ident = F.coalesce(F.when(F.col("seed_id") != "", F.col("seed_id")), F.concat(F.lit("source-"), F.col("ord").cast("string")))
    named = ordered.withColumns({"source_id": ident, "_text": X.squeeze(question), "_structure": X.structure_text(question), "_choices": X.labeled_choices(question)})
    return _with_features(named, ["source_id", "ord"])


#: Fields of a record that texts are taken from.
RECORD = ", ".join(f"{n} variant" for n in ["seed_id", "id", "question_id", "source_seed_id", "source_question", "question", "stem", "stimulus", "passage", "passages", "answer_groups"])


def record_texts(records: DataFrame, line: str = "line") -> DataFrame:
    """``records`` (JSON objects in ``line``) with ``_text``, ``_structure`` and ``_choices`` of each, whatever its shape.

    A string source_question is the whole text of a record; any other record has its stimulus, passages (strings or
    objects), stem, question and choices. Without choices in its groups those labelled in the first of
    source_question, question and stem count. Fields of other kinds than expected add nothing.
    """
    r = records.withColumn("_r", F.from_json(line, RECORD))
    names = ["source_question", "question", "stem", "stimulus", "passage"]
    r = r.withColumns({f"_{n}": V.string(F.col(f"_r.{n}")) for n in names})
    none = F.array().cast("array<string>")

    def text_of(p: Column) -> Column:
        return F.coalesce(V.string(p), V.string(V.key(p, "text")))

    passages = F.filter(F.concat(F.array("_passage"), F.transform(V.list_of(F.col("_r.passages")), text_of)), lambda p: F.coalesce(X.squeeze(p) != "", F.lit(False)))
    inner = F.flatten(F.transform(V.list_of(F.col("_r.answer_groups")), lambda g: F.transform(V.list_of(V.key(g, "choices")), lambda c: V.string(V.key(c, "text")))))
    r = r.withColumns({"_passages": passages, "_inner": F.coalesce(F.filter(inner, lambda t: t.isNotNull()), none)})
    ways = F.array("_inner", *[X.labeled_choices(F.col(f"_{n}")) for n in names[:3]])
    r = r.withColumn("_choices", F.coalesce(F.get(F.filter(ways, lambda w: F.size(w) > 0), F.lit(0)), none))
    (question,) = X.kept(F.col("_question"))
    whole = F.when(F.col("_source_question").isNotNull(), X.squeeze(F.col("_source_question"))).otherwise(
        X.item_text(F.col("_stimulus"), F.col("_passages"), F.col("_stem"), F.concat(F.array_compact(F.array(question)), F.col("_choices")))
    )
    shape = F.when(F.col("_source_question").isNotNull(), X.structure_text(F.col("_source_question"))).otherwise(X.item_structure_text(F.col("_stimulus"), F.col("_passages"), F.col("_stem")))
    return r.withColumns({"_text": whole, "_structure": shape}).drop(*[f"_{n}" for n in names], "_passages", "_inner")


def record_features(records: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """``keys`` and the features of raw item records."""
    return _with_features(record_texts(records, line), keys)


def source_record_features(records: DataFrame, ord_: str = "ord", line: str = "line") -> DataFrame:
    """(source_id, ord, features) of raw source records, seeds or items: named by the first of seed_id, id, question_id and
    source_seed_id that is neither null nor empty, else source-<ord>."""
    texts = record_texts(records, line)
    names = [F.nullif(V.text(F.col(f"_r.{n}")), F.lit("")) for n in ("seed_id", "id", "question_id", "source_seed_id")]
    named = texts.withColumns({"source_id": F.coalesce(*names, F.concat(F.lit("source-"), F.col(ord_).cast("string"))), "ord": F.col(ord_)})
    return _with_features(named, ["source_id", "ord"])


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``ord``, the 1-based place in the order of ``order`` (nulls first), by range-partitioned running counts."""
    from examsift.operators.prefix import running_sums

    return running_sums(df, [F.col(c).asc_nulls_first() for c in order], {"ord": F.lit(1).cast("long")})


# --- the index of sources


class SourceIndex:
    """Posting lists of the features of some sources."""

    def __init__(self, sources: pd.DataFrame, full: bool = True, ratios: bool = True):
        sources = sources.sort_values("ord")
        self.ids = sources["source_id"].tolist()
        self.full, self.ratios = full, ratios
        self.tokens, self.n_tokens = self._postings(sources["tokens"])
        if full:
            self.grams = [self._postings(sources[c]) for c in ("grams3", "grams4")]
            self.terms, _ = self._postings(sources["terms"])
            self.term_lists = [set(x) for x in sources["terms"]]
            self.structures = sources["structure"].tolist()
            self.structure_sizes = np.array([len(x) for x in self.structures], float)
            self.structure_chars = np.array([_characters(x) for x in self.structures], float).reshape(len(self.ids), 256)
            self.structure_bits = [_places(x) for x in self.structures]
            self.matchers: dict[int, SequenceMatcher] = {}
            self.choices: list[str] = []
            self.choice_owners: list[set[int]] = []
            at: dict[str, int] = {}
            for owner, choices in enumerate(sources["choices"]):
                for c in choices:
                    if c not in at:
                        at[c] = len(self.choices)
                        self.choices.append(c)
                        self.choice_owners.append(set())
                    self.choice_owners[at[c]].add(owner)
            self.choice_at = at
            self.choice_sizes = np.array([len(c) for c in self.choices], float)
            chars = np.array([_characters(c) for c in self.choices], np.int16).reshape(len(self.choices), 256)
            self.choice_columns = np.flatnonzero(chars.any(axis=0))  # characters that occur at all
            self.choice_chars = chars[:, self.choice_columns]
            self.choice_words = [set(c.split()) for c in self.choices]
            self.word_choices: dict[str, list[int]] = {}
            for i, words in enumerate(self.choice_words):
                for w in words:
                    self.word_choices.setdefault(w, []).append(i)
        self.known_choices: dict[str, frozenset[int]] = {}

    @staticmethod
    def _postings(lists: pd.Series) -> tuple[dict[str, np.ndarray], np.ndarray]:
        out: dict[str, list[int]] = {}
        for i, values in enumerate(lists):
            for v in values:
                out.setdefault(v, []).append(i)
        return {k: np.array(v, np.int64) for k, v in out.items()}, np.array([len(v) for v in lists], float)

    def _common(self, postings: dict[str, np.ndarray], values: list[str]) -> np.ndarray:
        found = [postings[v] for v in values if v in postings]
        return np.bincount(np.concatenate(found), minlength=len(self.ids)).astype(float) if found else np.zeros(len(self.ids))

    def lexical(self, tokens: list[str]) -> np.ndarray:
        if not tokens:
            return np.zeros(len(self.ids))
        common = self._common(self.tokens, tokens)
        return np.minimum(1.0, 0.65 * _over(common, len(tokens) + self.n_tokens - common, self.n_tokens) + 0.35 * _over(common, np.minimum(len(tokens), self.n_tokens), self.n_tokens))

    def phrase(self, grams: list[list[str]]) -> np.ndarray:
        best = np.zeros(len(self.ids))
        for values, (postings, sizes) in zip(grams, self.grams):
            if values:
                common = self._common(postings, values)
                best = np.maximum(best, np.maximum(_over(common, len(values) + sizes - common, sizes), 0.8 * _over(common, np.minimum(len(values), sizes), sizes)))
        return best

    def copies_of(self, choice: str) -> frozenset[int]:
        """Sources with a choice equal or nearly equal to this one."""
        if choice not in self.known_choices:
            if len(self.known_choices) > 200_000:
                self.known_choices.clear()
            close = {self.choice_at[choice]} if choice in self.choice_at else set()
            words = set(choice.split())
            for i in {i for w in words for i in self.word_choices.get(w, ())} - close:
                other = self.choice_words[i]
                both = len(words & other)
                if both / (len(words) + len(other) - both) >= NEAR_COPY_TOKENS:
                    close.add(i)
            if self.choices and self.ratios:
                # the matching characters are no more than the common ones, so this bounds the ratio
                bound = 2 * np.minimum(self.choice_chars, _characters(choice)[self.choice_columns].astype(np.int16)).sum(axis=1) / (self.choice_sizes + len(choice))
                for i in np.flatnonzero(bound >= NEAR_COPY_RATIO).tolist():
                    if i not in close and SequenceMatcher(None, choice, self.choices[i]).ratio() >= NEAR_COPY_RATIO:
                        close.add(i)
            self.known_choices[choice] = frozenset(o for i in close for o in self.choice_owners[i])
        return self.known_choices[choice]

    def _structure_ratio(self, i: int, structure: str) -> float:
        if i not in self.matchers:
            self.matchers[i] = SequenceMatcher(None, "", self.structures[i])
        self.matchers[i].set_seq1(structure)
        return self.matchers[i].ratio()

    def riskiest_lexical(self, tokens: list[str]) -> tuple[int, float]:
        scores = np.round(self.lexical(tokens), 9)
        best = int(scores.argmax())
        return best, float(scores[best])

    def riskiest(self, tokens: list[str], grams3: list[str], grams4: list[str], choices: list[str], terms: list[str], structure: str) -> tuple[int, list[float], list[str], list[str]]:
        """(source, components, copied choices, reused terms) of the source with the lowest rounded novelty; ties go to the earliest."""
        lexical, phrase = self.lexical(tokens), self.phrase([grams3, grams4])
        entity = self._common(self.terms, terms) / len(terms) if terms else np.zeros(len(self.ids))
        copied = np.zeros(len(self.ids))
        owners = [self.copies_of(c) for c in choices]
        for found in owners:
            copied[list(found)] += 1
        choice = copied / len(choices) if choices else copied
        known = WEIGHTS["lexical"] * lexical + WEIGHTS["phrase"] * phrase + WEIGHTS["choice"] * choice + WEIGHTS["entity"] * entity
        size = len(structure) if self.ratios else 0
        bound = np.zeros(len(self.ids))
        if size:
            common = np.minimum(self.structure_chars, _characters(structure)).sum(axis=1)
            bound = np.where(self.structure_sizes > 0, 2 * common / (self.structure_sizes + size), 0.0)
        top = known + WEIGHTS["structure"] * bound
        best, ratios = -1.0, {}
        for i in np.argsort(-top, kind="stable").tolist():
            if top[i] < best - ROUNDING:
                break
            if size and self.structures[i]:
                # matching blocks form a common subsequence, so its length is a closer bound
                whole = size + len(self.structures[i])
                closer = 2 * _common_subsequence(self.structure_bits[i], len(self.structures[i]), structure) / whole
                if known[i] + WEIGHTS["structure"] * closer < best - ROUNDING:
                    continue
                ratios[i] = self._structure_ratio(i, structure)
            else:
                ratios[i] = 0.0
            best = max(best, known[i] + WEIGHTS["structure"] * ratios[i])
        riskiest = min(ratios, key=lambda i: (novelty_of(known[i] + WEIGHTS["structure"] * ratios[i]), i))
        parts = [float(x) for x in (lexical[riskiest], phrase[riskiest], choice[riskiest], entity[riskiest], ratios[riskiest])]
        return riskiest, parts, sorted({c for c, o in zip(choices, owners) if riskiest in o}), sorted(set(terms) & self.term_lists[riskiest])


def novelty_of(similarity: float) -> float:
    return round(min(100.0, max(0.0, 100.0 * (1.0 - similarity))), 1)


def _characters(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.bincount(np.minimum(codes, 255), minlength=256)


def _places(text: str) -> dict[str, int]:
    """For each character the bits of the places where it stands."""
    bits: dict[str, int] = {}
    for i, c in enumerate(text):
        bits[c] = bits.get(c, 0) | 1 << i
    return bits


def _common_subsequence(bits: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence, a word of bits at a time."""
    full = (1 << size) - 1
    open_ = full
    for c in other:
        hit = open_ & bits.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return size - open_.bit_count()


def _over(part: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros_like(part), where=(sizes > 0) & (whole > 0))


def _blocks_of(sources: DataFrame, at_once: int) -> Iterator[pd.DataFrame]:
    """Features of sources in blocks of ``at_once`` rows, in order; one block is on the driver at a time."""
    rows: list = []
    for row in sources.orderBy("ord").toLocalIterator():
        rows.append(row.asDict())
        if len(rows) == at_once:
            yield pd.DataFrame(rows)
            rows = []
    if rows:
        yield pd.DataFrame(rows)


_RISK = T.StructType([
    T.StructField("novelty", T.DoubleType()),
    T.StructField("place", T.LongType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("similarity", T.DoubleType()),
    *[T.StructField(c, T.DoubleType()) for c in COMPONENTS],
    T.StructField("copied", T.ArrayType(T.StringType())),
    T.StructField("reused", T.ArrayType(T.StringType())),
])
_LEX = T.StructType([T.StructField("novelty", T.DoubleType()), T.StructField("place", T.LongType()), T.StructField("source_id", T.StringType())])


def _compared(rows: DataFrame, index: SourceIndex, before: int, kind: T.StructType) -> DataFrame:
    """``rows`` with ``_risk``: the better of the one they have and the riskiest source of ``index``, whose sources
    follow ``before`` earlier ones. Other columns pass through as they are."""
    from pyspark.sql.pandas.types import to_arrow_type

    names = [c for c in rows.columns if c != "_risk"]
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("_risk", kind)])
    arrow, full = to_arrow_type(kind), kind == _RISK

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            prior = column["_risk"].to_pylist() if "_risk" in column else [None] * batch.num_rows
            found = []
            for old, values in zip(prior, zip(*(column[f].to_pylist() for f in (FEATURES if full else FEATURES[:1])))):
                if full:
                    i, parts, copied, reused = index.riskiest(*values)
                    likeness = sum(WEIGHTS[c] * x for c, x in zip(COMPONENTS, parts))
                    new = {"novelty": novelty_of(likeness), "similarity": round(100 * min(1.0, max(0.0, likeness)), 1), **{c: novelty_of(x) for c, x in zip(COMPONENTS, parts)}, "copied": copied, "reused": reused}
                else:
                    i, likeness = index.riskiest_lexical(*values)
                    new = {"novelty": -likeness}
                new |= {"place": before + i, "source_id": index.ids[i]}
                found.append(old if old and old["novelty"] <= new["novelty"] else new)
            yield pa.RecordBatch.from_arrays([*[column[n] for n in names], pa.array(found, arrow)], names=[*names, "_risk"])

    return rows.mapInArrow(compare, schema)


def _against(features: DataFrame, sources: DataFrame, at_once: int, kind: T.StructType, ratios: bool = True) -> DataFrame:
    """``features`` with ``_risk`` over all sources, null if there are none."""
    rows, before = features, 0
    for block in _blocks_of(sources, at_once):
        rows = _compared(rows, SourceIndex(block, kind == _RISK, ratios), before, kind)
        before += len(block)
    return rows if before else rows.withColumn("_risk", F.lit(None).cast(kind))


def _gate_reasons(score: Column, copied: Column, reused: Column, threshold: float) -> Column:
    return F.array_compact(F.array(
        F.when(score < threshold, F.lit(f"novelty_score below {threshold:g}")),
        F.when(F.size(copied) > 0, F.lit("copied or near-copied answer choice")),
        F.when(F.size(reused) > 0, F.lit("reused distinctive entity or number")),
    ))


def score_novelty(features: DataFrame, sources: DataFrame, keys: list[str], threshold: float = NOVELTY_THRESHOLD, at_once: int = SOURCES_AT_ONCE, ratios: bool = True) -> DataFrame:
    """``keys`` and the novelty columns of each item against its riskiest source.

    Scores, similarities and components are rounded alike (half to even on the exact value). Without ``ratios`` nothing
    is compared by its sequence: structures count as unlike, choices as copied only by equality or their words.

    ``features`` are item features with ``keys``, ``sources`` source features. Without any source an item is
    wholly new: score 100, no source. More than ``at_once`` sources take several passes whose results are
    compared per row. The riskiest source is chosen by the score rounded to one place.
    """
    rows = _against(features.select(*keys, *FEATURES), sources, at_once, _RISK, ratios)
    risk = F.col("_risk")
    none = F.array().cast("array<string>")
    score = F.coalesce(risk["novelty"], F.lit(100.0))
    copied, reused = F.coalesce(risk["copied"], none), F.coalesce(risk["reused"], none)
    reasons = _gate_reasons(score, copied, reused, threshold)
    parts = {"lexical": "lexical_novelty", "phrase": "phrase_novelty", "choice": "answer_choice_novelty", "entity": "entity_number_novelty", "structure": "structure_novelty"}
    return rows.select(
        *keys,
        score.alias("novelty_score"),
        risk["source_id"].alias("max_similarity_source_id"),
        F.coalesce(risk["similarity"], F.lit(0.0)).alias("max_similarity_score"),
        F.struct(*[F.coalesce(risk[c], F.lit(100.0)).alias(n) for c, n in parts.items()]).alias("novelty_components"),
        (F.size(reasons) == 0).alias("novelty_pass"),
        F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("passes novelty gate"))).alias("novelty_reasons"),
        copied.alias("copied_answer_choices"),
        reused.alias("reused_distinctive_terms"),
    )


def lexical_riskiest(features: DataFrame, sources: DataFrame, keys: list[str], at_once: int = SOURCES_AT_ONCE) -> DataFrame:
    """``keys``, source_id and lexical (6 places): the lexically most similar source, ties to the earliest; null and 0 without sources."""
    rows = _against(features.select(*keys, "tokens"), sources.select("source_id", "ord", "tokens"), at_once, _LEX)
    return rows.select(*keys, "_risk.source_id", F.coalesce(F.round(-F.col("_risk.novelty"), 6), F.lit(0.0)).alias("lexical"))


# --- summaries


def novelty_summary(scored: DataFrame, threshold: float = NOVELTY_THRESHOLD) -> DataFrame:
    """One row: items, passed, failed, mean and least score (one place; null without items)."""
    return scored.agg(
        F.lit(threshold).alias("threshold"),
        F.count(F.lit(1)).alias("total_items"),
        F.count_if(F.col("novelty_pass").eqNullSafe(True)).alias("passed_items"),
        F.count_if(~F.col("novelty_pass").eqNullSafe(True)).alias("failed_items"),
        F.round(F.avg("novelty_score"), 1).alias("average_novelty_score"),
        F.round(F.min("novelty_score"), 1).alias("minimum_novelty_score"),
    )


def failure_reasons(scored: DataFrame) -> DataFrame:
    """(reason, items) over the items that fail."""
    failed = scored.filter(~F.col("novelty_pass").eqNullSafe(True))
    return failed.select(F.explode("novelty_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))
