"""The validation rules once more, as SQL (DuckDB) over JSON: the check of the rules engine."""

from __future__ import annotations

from examsift.functions.constants import PASSAGE_SUBTYPES, QUESTION_TYPES, REASONING_SUBTYPES

_LINES = "rec AS (SELECT line_no AS ord, line::JSON AS j FROM item_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT')"
_ITEMS = """rec AS (SELECT item_ord AS ord, json_merge_patch('{}'::JSON, json_object('id', id, 'question_type', question_type, 'stem', stem, 'answer_groups', answer_groups, 'explanation', explanation,
  'subtype', subtype, 'stimulus', stimulus, 'passage', passage, 'passages', passages, 'passage_set_id', passage_set_id)) AS j FROM generated_items)"""


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _filled(v: str, path: str) -> str:
    return f"coalesce(json_type({v}, '{path}') = 'VARCHAR' AND regexp_replace({v} ->> '{path}', '\\s+', '', 'g') <> '', false)"


def _text(v: str, path: str) -> str:
    return f"CASE json_type({v}, '{path}') WHEN 'VARCHAR' THEN {v} ->> '{path}' END"


def _size(v: str, path: str) -> str:
    return f"CASE json_type({v}, '{path}') WHEN 'ARRAY' THEN json_array_length({v}, '{path}') WHEN 'OBJECT' THEN len(json_keys({v}, '{path}')) WHEN 'VARCHAR' THEN length({v} ->> '{path}') ELSE 0 END"


def _shown(v: str, path: str) -> str:
    return f"CASE WHEN coalesce(json_type({v}, '{path}'), 'NULL') = 'NULL' THEN 'None' ELSE {v} ->> '{path}' END"


def _list(v: str, path: str) -> str:
    return f"CASE WHEN json_type({v}, '{path}') = 'ARRAY' THEN ({v} -> '{path}')::JSON[] ELSE [] END"


def _errors(records: str, typed: bool) -> str:
    """WITH … errors(ord, rule, message), one row per error."""
    null_is_absent = " AND json_type({}, '$.{}') <> 'NULL'" if typed else ""
    rules: list[tuple[str, str, str, str]] = []  # (table, rule, condition, message)
    for k in ("id", "question_type", "stem", "answer_groups", "explanation"):
        rules.append(("rec", "V1", f"json_type(j, '$.{k}') IS NULL", f"'missing required field ''{k}'''"))
    rules += [
        ("rec", "V2", f"NOT coalesce({_text('j', '$.question_type')} IN {_in(QUESTION_TYPES)}, false)", f"'invalid question_type ''' || {_shown('j', '$.question_type')} || ''''"),
        ("rec", "V3", f"NOT {_filled('j', '$.stem')}", "'stem must be a non-empty string'"),
        ("rec", "V4", f"NOT {_filled('j', '$.explanation')}", "'explanation must be a non-empty string'"),
        ("rec", "V5", f"len({_list('j', '$.answer_groups')}) = 0", "'answer_groups must be a non-empty list'"),
        ("g", "V6", "coalesce(json_type(g), 'NULL') <> 'OBJECT'", "'answer group must be an object'"),
        ("og", "V7", "len(labels) = 0", "'answer group has no labeled choices'"),
        ("og", "V8", "len(list_distinct(labels)) < len(labels)", "'duplicate choice labels in answer group'"),
        ("og", "V9", "len(given) = 0", "'answer group missing correct_labels'"),
        ("og", "internal", f"json_type(g, '$.choices') <> 'ARRAY'{null_is_absent.format('g', 'choices')}", "'choices must be a list'"),
        ("og", "V10", "len(absent) > 0", "'correct labels not found in choices: [' || array_to_string(absent, ', ') || ']'"),
        ("c", "V11", "coalesce(json_type(c), 'NULL') <> 'OBJECT'", "'choice must be an object'"),
        ("c", "V12", f"json_type(c) = 'OBJECT' AND NOT {_filled('c', '$.label')}", "'choice missing label'"),
        ("c", "V13", f"json_type(c) = 'OBJECT' AND NOT {_filled('c', '$.text')}", "'choice missing text'"),
        ("t", "V14", "asked = 'text_completion' AND n > 3", "'text_completion must have 1-3 answer groups'"),
        ("og", "V15", "asked = 'text_completion' AND json_type(g, '$.correct_labels') = 'ARRAY' AND len(given) <> 1", "'each text_completion blank needs exactly one answer'"),
        ("t", "V16", "asked = 'sentence_equivalence' AND n <> 1", "'sentence_equivalence must have one answer group'"),
        ("t", "V17", f"asked = 'sentence_equivalence' AND n = 1 AND {_size('first', '$.choices')} <> 6", "'sentence_equivalence must have exactly six choices'"),
        ("t", "V18", f"asked = 'sentence_equivalence' AND n = 1 AND {_size('first', '$.correct_labels')} <> 2", "'sentence_equivalence must have exactly two correct labels'"),
        ("t", "V20", f"of_set AND NOT coalesce(subtype IN {_in(PASSAGE_SUBTYPES)}, false)", f"'invalid LSAT reading_comprehension subtype ''' || {_shown('j', '$.subtype')} || ''''"),
        ("t", "V21", f"of_set AND NOT {_filled('j', '$.passage_set_id')}", "'LSAT reading_comprehension must include passage_set_id'"),
        ("t", "V24", "of_set AND json_type(j, '$.passages') = 'ARRAY' AND json_array_length(j, '$.passages') <> due", f"'subtype ''' || {_shown('j', '$.subtype')} || ''' requires ' || due || ' passage' || CASE due WHEN 2 THEN 's' ELSE '' END"),
        ("t", "V25", f"asked = 'reading_comprehension' AND NOT of_set AND NOT {_filled('j', '$.passage')}", "'reading_comprehension must include a passage'"),
        ("t", "V26", f"asked = 'logical_reasoning' AND NOT coalesce(subtype IN {_in(REASONING_SUBTYPES)}, false)", f"'invalid logical_reasoning subtype ''' || {_shown('j', '$.subtype')} || ''''"),
        ("t", "V27", f"asked = 'logical_reasoning' AND NOT {_filled('j', '$.stimulus')}", "'logical_reasoning must include a stimulus'"),
        ("t", "V29", "best IS NOT NULL AND n <> 1", "best || ' must have one answer group'"),
        ("t", "V30", "best IS NOT NULL AND n = 1 AND coalesce(json_type(first), 'NULL') <> 'OBJECT'", "best || ' answer group must be an object'"),
        ("t", "V31", "best IS NOT NULL AND n = 1 AND json_type(first) = 'OBJECT' AND json_type(first, '$.blank') <> 'NULL'", "best || ' answer group must use blank null'"),
        ("t", "V32", f"best IS NOT NULL AND n = 1 AND json_type(first) = 'OBJECT' AND {_size('first', '$.choices')} <> 5", "best || ' must have exactly five choices'"),
        ("t", "V33", f"best IS NOT NULL AND n = 1 AND json_type(first) = 'OBJECT' AND {_size('first', '$.correct_labels')} <> 1", "best || ' must have exactly one correct label'"),
        ("t", "V34", "of_set AND len(ps) = 0", "'passages must be a non-empty list'"),
        ("p", "V35", f"json_type(p) = 'VARCHAR' AND NOT {_filled('p', '$')}", "'passage ' || k || ' must be a non-empty string'"),
        ("p", "V36", "coalesce(json_type(p), 'NULL') NOT IN ('VARCHAR', 'OBJECT')", "'passage ' || k || ' must be a string or object'"),
        ("p", "V37", f"json_type(p) = 'OBJECT' AND NOT {_filled('p', '$.text')}", "'passage ' || k || ' missing text'"),
        ("p", "V38", f"json_type(p, '$.label') IS NOT NULL AND NOT {_filled('p', '$.label')}{null_is_absent.format('p', 'label')}", "'passage ' || k || ' has invalid label'"),
        ("(SELECT ord, list(p ->> '$.label') AS l FROM p WHERE " + _filled("p", "$.label") + " GROUP BY ord)", "V39", "len(list_distinct(l)) < len(l)", "'duplicate passage labels'"),
    ]
    each = "\nUNION ALL ".join(f"SELECT ord, '{name}' AS rule, {message} AS message FROM {table} WHERE {when}" for table, name, when, message in rules)
    label = "CASE WHEN json_type(c, '$.label') = 'VARCHAR' THEN c ->> '$.label' END"
    return f"""
WITH {records},
t AS (SELECT *, len(gs) AS n, gs[1] AS first, asked = 'reading_comprehension' AND (coalesce(subtype IN {_in(PASSAGE_SUBTYPES)}, false) OR coalesce(json_type(j, '$.passages'), 'NULL') <> 'NULL' OR coalesce(json_type(j, '$.passage_set_id'), 'NULL') <> 'NULL') AS of_set,
  CASE WHEN asked = 'logical_reasoning' THEN asked WHEN of_set THEN 'LSAT reading_comprehension' END AS best, CASE WHEN subtype = 'comparative_passages' THEN 2 ELSE 1 END AS due
  FROM (SELECT ord, j, {_list('j', '$.answer_groups')} AS gs, {_list('j', '$.passages')} AS ps, {_text('j', '$.question_type')} AS asked, {_text('j', '$.subtype')} AS subtype FROM rec) WHERE len(gs) > 0),
g AS (SELECT ord, asked, unnest(gs) AS g FROM t),
og AS (SELECT *, list_transform(list_filter(given, lambda x: NOT coalesce(json_type(x) = 'VARCHAR' AND list_contains(labels, x ->> '$'), false)), lambda x: CASE json_type(x) WHEN 'VARCHAR' THEN '''' || (x ->> '$') || '''' ELSE coalesce(x::VARCHAR, 'None') END) AS absent
  FROM (SELECT ord, asked, g, {_list('g', '$.correct_labels')} AS given, list_filter(list_transform({_list('g', '$.choices')}, lambda c: {label}), lambda x: x IS NOT NULL) AS labels FROM g WHERE json_type(g) = 'OBJECT')),
c AS (SELECT ord, unnest({_list('g', '$.choices')}) AS c FROM g WHERE json_type(g) = 'OBJECT'),
p AS (SELECT ord, unnest(range(1, len(ps) + 1)) AS k, unnest(ps) AS p FROM t WHERE of_set),
errors AS ({each})
"""


def item_errors() -> str:
    """WITH … errors(ord, rule, message) of generated_items."""
    return _errors(_ITEMS, True)


def oracle_sql() -> dict[str, str]:
    lines, items = _errors(_LINES, False), _errors(_ITEMS, True)
    counts = "SELECT rule, sum(n)::BIGINT AS errors, count(*) AS records FROM (SELECT rule, ord, count(*) AS n FROM errors GROUP BY rule, ord) GROUP BY rule"
    return {
        "rule_counts": lines.replace("line_no AS ord", "row_number() OVER () AS ord") + counts,
        "line_errors": lines + "SELECT ord AS line_no, 'line ' || ord || ': ' || message AS error FROM errors",
        "validation_totals": lines.replace("line_no AS ord", "row_number() OVER () AS ord") + "SELECT (SELECT count(*) FROM rec) AS records, (SELECT count(DISTINCT ord) FROM errors) AS invalid_records, (SELECT count(*) FROM errors) AS errors",
        "item_rule_counts": items.replace("item_ord AS ord", "row_number() OVER () AS ord") + counts,
    }
