"""Validation of item records by rules.

Rules are data: a name, a test and a message, in lists by what they look at (record, answer group, choice,
passage). A record is decoded once, in Arrow batches; the lists are then asked in order, so a record's
errors keep the order of the tables below and nested rules report where their part stands. A wrongly typed
element is evidence and erases nothing else.

A record whose shape no rule foresees (choices that are null, say) gets ``internal`` errors of its own
instead of stopping the run.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.functions.constants import PASSAGE_SUBTYPES, QUESTION_TYPES, REASONING_SUBTYPES

REQUIRED = ["id", "question_type", "stem", "answer_groups", "explanation"]
#: Fields of a record that rules look at.
FIELDS = [*REQUIRED, "subtype", "stimulus", "passage", "passages", "passage_set_id"]
ERRORS = T.ArrayType(T.StructType([T.StructField("rule", T.StringType()), T.StructField("message", T.StringType())]))


@dataclass(frozen=True)
class Rule:
    """``broken`` says whether the rule is broken; after a broken rule that ``ends`` its list nothing more of it is asked."""

    name: str
    broken: Callable[[Any], Any]
    message: str | Callable[[Any], str]
    ends: bool = False


@dataclass(frozen=True)
class Each:
    """Further rules for each part that ``parts`` gives."""

    parts: Callable[[Any], list]
    rules: list


def _filled(value: Any) -> bool:
    return isinstance(value, str) and bool(value.strip())


def _listed(value: Any) -> list:
    return value if isinstance(value, list) else []


def _size(value: Any) -> int:
    return len(value) if isinstance(value, (list, dict, str)) else 0


def _one_of(value: Any, known: list[str]) -> bool:
    return isinstance(value, str) and value in known


def _repeat(values: list) -> bool:
    return len(set(values)) < len(values)


class Part:
    """A value and, if it is an object, its fields."""

    def __init__(self, value: Any, place: int = 0):
        self.value, self.place = value, place
        self.is_object = isinstance(value, dict)
        self.fields: dict = value if self.is_object else {}

    def get(self, name: str) -> Any:
        return self.fields.get(name)


class Group(Part):
    @cached_property
    def choices(self) -> list[Part]:
        return [Part(c) for c in _listed(self.get("choices"))]

    @cached_property
    def labels(self) -> list[str]:
        """String labels of the choices, blank ones too."""
        return [c.get("label") for c in self.choices if isinstance(c.get("label"), str)]

    @cached_property
    def absent(self) -> list:
        """Correct labels that no choice has; a number is not the text of that number."""
        return [x for x in _listed(self.get("correct_labels")) if x not in self.labels]


class Record(Part):
    @cached_property
    def groups(self) -> list[Group]:
        return [Group(g) for g in _listed(self.get("answer_groups"))]

    @cached_property
    def passages(self) -> list[Part]:
        return [Part(p, n) for n, p in enumerate(_listed(self.get("passages")), 1)]

    @cached_property
    def passages_due(self) -> int:
        return 2 if self.get("subtype") == "comparative_passages" else 1

    @cached_property
    def of_type(self) -> list:
        """The rules of the record's question type."""
        asked = self.get("question_type")
        return BY_TYPE.get(asked, []) if isinstance(asked, str) else []

    @cached_property
    def has_set(self) -> bool:
        """V19: which of its two forms a reading item takes."""
        return _one_of(self.get("subtype"), PASSAGE_SUBTYPES) or self.get("passages") is not None or self.get("passage_set_id") is not None


CHOICE = [
    Rule("V11", lambda c: not c.is_object, "choice must be an object", ends=True),
    Rule("V12", lambda c: not _filled(c.get("label")), "choice missing label"),
    Rule("V13", lambda c: not _filled(c.get("text")), "choice missing text"),
]
GROUP = [
    Rule("V6", lambda g: not g.is_object, "answer group must be an object", ends=True),
    Rule("V7", lambda g: not g.labels, "answer group has no labeled choices"),
    Rule("V8", lambda g: _repeat(g.labels), "duplicate choice labels in answer group"),
    Rule("V9", lambda g: not _listed(g.get("correct_labels")), "answer group missing correct_labels"),
    Rule("internal", lambda g: "choices" in g.fields and not isinstance(g.get("choices"), list), "choices must be a list"),
    Rule("V10", lambda g: g.absent, lambda g: f"correct labels not found in choices: {g.absent}"),
    Each(lambda g: g.choices, CHOICE),
]
PASSAGE = [
    Rule("V35", lambda p: isinstance(p.value, str) and not _filled(p.value), lambda p: f"passage {p.place} must be a non-empty string", ends=True),
    Rule("V36", lambda p: not isinstance(p.value, str) and not p.is_object, lambda p: f"passage {p.place} must be a string or object", ends=True),
    Rule("V37", lambda p: p.is_object and not _filled(p.get("text")), lambda p: f"passage {p.place} missing text"),
    Rule("V38", lambda p: "label" in p.fields and not _filled(p.get("label")), lambda p: f"passage {p.place} has invalid label"),
]
PASSAGES = [
    Rule("V34", lambda r: not r.passages, "passages must be a non-empty list", ends=True),
    Each(lambda r: r.passages, PASSAGE),
    Rule("V39", lambda r: _repeat([p.get("label") for p in r.passages if _filled(p.get("label"))]), "duplicate passage labels"),
]


def _single_best(name: str) -> list:
    """Rules of items with one best answer."""
    return [
        Rule("V29", lambda r: len(r.groups) != 1, f"{name} must have one answer group", ends=True),
        Rule("V30", lambda r: not r.groups[0].is_object, f"{name} answer group must be an object", ends=True),
        Rule("V31", lambda r: r.groups[0].get("blank") is not None, f"{name} answer group must use blank null"),
        Rule("V32", lambda r: _size(r.groups[0].get("choices")) != 5, f"{name} must have exactly five choices"),
        Rule("V33", lambda r: _size(r.groups[0].get("correct_labels")) != 1, f"{name} must have exactly one correct label"),
    ]


def _same(r: Record) -> list:
    """The record itself as a part: a list within a list, whose end ends only itself."""
    return [r]


READING_SET = [
    Rule("V20", lambda r: not _one_of(r.get("subtype"), PASSAGE_SUBTYPES), lambda r: f"invalid LSAT reading_comprehension subtype '{r.get('subtype')}'"),
    Rule("V21", lambda r: not _filled(r.get("passage_set_id")), "LSAT reading_comprehension must include passage_set_id"),
    Each(_same, _single_best("LSAT reading_comprehension")),
    Each(_same, PASSAGES),
    Rule("V24", lambda r: isinstance(r.get("passages"), list) and len(r.passages) != r.passages_due, lambda r: f"subtype '{r.get('subtype')}' requires {r.passages_due} passage" + "s" * (r.passages_due > 1)),
]
BY_TYPE: dict[str, list] = {
    "text_completion": [
        Rule("V14", lambda r: len(r.groups) > 3, "text_completion must have 1-3 answer groups"),
        Each(lambda r: r.groups, [Rule("V15", lambda g: isinstance(g.get("correct_labels"), list) and len(g.get("correct_labels")) != 1, "each text_completion blank needs exactly one answer")]),
    ],
    "sentence_equivalence": [
        Rule("V16", lambda r: len(r.groups) != 1, "sentence_equivalence must have one answer group", ends=True),
        Rule("V17", lambda r: _size(r.groups[0].get("choices")) != 6, "sentence_equivalence must have exactly six choices"),
        Rule("V18", lambda r: _size(r.groups[0].get("correct_labels")) != 2, "sentence_equivalence must have exactly two correct labels"),
    ],
    "reading_comprehension": [
        Each(lambda r: [r] if r.has_set else [], READING_SET),
        Rule("V25", lambda r: not r.has_set and not _filled(r.get("passage")), "reading_comprehension must include a passage"),
    ],
    "logical_reasoning": [
        Rule("V26", lambda r: not _one_of(r.get("subtype"), REASONING_SUBTYPES), lambda r: f"invalid logical_reasoning subtype '{r.get('subtype')}'"),
        Rule("V27", lambda r: not _filled(r.get("stimulus")), "logical_reasoning must include a stimulus"),
        Each(_same, _single_best("logical_reasoning")),
    ],
}
RECORD = [
    *[Rule("V1", lambda r, k=k: k not in r.fields, f"missing required field '{k}'") for k in REQUIRED],
    Rule("V2", lambda r: not _one_of(r.get("question_type"), QUESTION_TYPES), lambda r: f"invalid question_type '{r.get('question_type')}'"),
    Rule("V3", lambda r: not _filled(r.get("stem")), "stem must be a non-empty string"),
    Rule("V4", lambda r: not _filled(r.get("explanation")), "explanation must be a non-empty string"),
    Rule("V5", lambda r: not r.groups, "answer_groups must be a non-empty list", ends=True),
    Each(lambda r: r.groups, GROUP),
]


def broken_rules(rules: list, part: Any) -> Iterator[tuple[str, str]]:
    """(rule, message) of the rules that ``part`` breaks, in order."""
    for rule in rules:
        if isinstance(rule, Each):
            for inner in rule.parts(part):
                yield from broken_rules(rule.rules, inner)
        elif rule.broken(part):
            yield rule.name, rule.message if isinstance(rule.message, str) else rule.message(part)
            if rule.ends:
                return


def record_errors(line: str | None) -> list[tuple[str, str]]:
    """Errors of a record given as JSON; none for a text that is no object."""
    try:
        value = json.loads(line or "null")
    except (ValueError, RecursionError):
        return []
    if not isinstance(value, dict):
        return []
    record, found = Record(value), []
    try:
        found += broken_rules(RECORD, record)
        if record.groups:
            found += broken_rules(record.of_type, record)
    except Exception as problem:  # a shape no rule foresees must not stop the run
        found.append(("internal", f"{type(problem).__name__}: {problem}"))
    return found


def rule_errors(line: Column) -> Column:
    """ARRAY<STRUCT<rule, message>> of a record's JSON text; empty for a valid record and for what is no object."""

    @F.arrow_udf(ERRORS)
    def check(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, said, ends = [], [], [0]
            for x in batch.to_pylist():
                for name, message in record_errors(x):
                    names.append(name)
                    said.append(message)
                ends.append(len(names))
            each = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(said, pa.string())], ["rule", "message"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)

    return check(line)


def with_errors(records: DataFrame, line: str = "line", out: str = "rule_errors") -> DataFrame:
    """``records`` with the array of (rule, message) the JSON record in ``line`` breaks; empty for a valid record."""
    return records.withColumn(out, rule_errors(F.col(line)))


def item_errors(items: DataFrame, out: str = "rule_errors") -> DataFrame:
    """The same for typed items: null columns are left out of the record, as a writer of JSON lines would leave them."""
    return items.withColumn(out, rule_errors(F.to_json(F.struct(*[c for c in FIELDS if c in items.columns]))))


def error_texts(errors: Column, line_no: Column) -> Column:
    """Messages with the number of the line (or record) they belong to."""
    return F.transform(errors, lambda e: F.concat(F.lit("line "), line_no.cast("string"), F.lit(": "), e["message"]))


def rule_counts(validated: DataFrame, errors: str = "rule_errors") -> DataFrame:
    """(rule, errors, records): how often each rule is broken, and in how many records. One aggregation, combined before its shuffle."""
    rules = F.transform(errors, lambda e: e["rule"])
    each = validated.select(F.explode(F.transform(F.array_distinct(rules), lambda r: F.struct(r.alias("rule"), F.size(F.filter(rules, lambda x: x == r)).alias("n")))).alias("_e"))
    return each.groupBy("_e.rule").agg(F.sum("_e.n").alias("errors"), F.count(F.lit(1)).alias("records"))


def validation_totals(validated: DataFrame, errors: str = "rule_errors") -> DataFrame:
    """One row: records, records with errors, errors."""
    return validated.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.size(errors) > 0).alias("invalid_records"), F.coalesce(F.sum(F.size(errors)), F.lit(0)).alias("errors"))
