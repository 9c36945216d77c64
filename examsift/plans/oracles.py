"""SQL (DuckDB) that gives the same rows as queries of the catalogue, by other means."""

from __future__ import annotations

from examsift.functions.constants import ANSWER_KEYS, NAME_JOINERS, NEAR_COPY_TOKENS, NO_NAMES, STOPWORDS, WEIGHTS
from examsift.operators.audit import PROFILES
from examsift.plans import rule_sql


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _squeeze(x: str) -> str:
    return rf"regexp_replace(regexp_replace(coalesce({x}, ''), '[\s\v\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g'), '^ | $', '', 'g')"


def _match(x: str) -> str:
    inner = rf"regexp_replace(lower({_squeeze(x)}), '\[[^\]]*blank[^\]]*\]', 'blank', 'g')"
    return _squeeze(f"regexp_replace({inner}, '[^a-z0-9%]+', ' ', 'g')")


_NUMBER = r"\p{Nd}+(?:[.,:/-]\p{Nd}+)*(?:%| percent)?"


def _content(x: str) -> str:
    found = f"list_transform(regexp_extract_all(coalesce({x}, ''), '[A-Za-z][A-Za-z''-]*|{_NUMBER}'), lambda t: trim(lower(t), ''''))"
    return f"list_filter({found}, lambda t: length(t) > 2 AND NOT list_contains({_list(STOPWORDS)}, t))"


def _grams(w: str, n: int) -> str:
    return f"list_distinct(list_transform(range(1, greatest(len({w}) - {n - 2}, 1)), lambda i: array_to_string({w}[i:i + {n - 1}], chr(1))))"


_ITEM_TEXTS = f"""
parts AS (SELECT item_ord, source_seed_id, stem, stimulus,
    list_filter(list_concat([passage], coalesce(list_transform(passages, lambda p: p.text), [])), lambda p: coalesce({_squeeze('p')} <> '', false)) AS ps,
    list_filter(coalesce(flatten(list_transform(answer_groups, lambda g: coalesce(list_transform(g.choices, lambda c: c.text), []))), []), lambda t: t IS NOT NULL) AS cs
    FROM generated_items),
texts AS (SELECT item_ord, source_seed_id, ps, cs,
    {_squeeze("array_to_string(list_filter(list_concat([CASE WHEN " + _squeeze("stimulus") + " <> '' THEN stimulus END], ps, [CASE WHEN " + _squeeze("stem") + " <> '' THEN stem END], cs), lambda t: t IS NOT NULL), ' ')")} AS main_text,
    {_squeeze("array_to_string(list_filter(list_concat([CASE WHEN " + _squeeze("stimulus") + " <> '' THEN stimulus END], ps, [CASE WHEN " + _squeeze("stem") + " <> '' THEN stem END]), lambda t: t IS NOT NULL), ' ')")} AS structure_text
    FROM parts)"""

def _choices(x: str) -> str:
    parts = rf"string_split(regexp_replace({x}, '(^|\s)[A-F]\.\s+', chr(2), 'g'), chr(2))"
    return f"list_filter(list_transform(({parts})[2:], lambda p: trim({_squeeze('p')}, ' ;,')), lambda p: p <> '')"


def _terms(x: str) -> str:
    numbers = rf"regexp_extract_all({x}, '\b{_NUMBER}\b')"
    joiners = "|".join(NAME_JOINERS)
    names = rf"list_transform(regexp_extract_all(regexp_replace({x}, '\b[A-F]\.', ' ', 'g'), '\b[A-Z][a-z]+(?:\s+(?:{joiners}|[A-Z][a-z]+))*'), lambda n: {_squeeze('n')})"
    own = f"list_filter(string_split(n, ' '), lambda w: NOT list_contains({_list(NAME_JOINERS)}, lower(w)))"
    kept = f"list_filter({names}, lambda n: CASE len({own}) WHEN 0 THEN false WHEN 1 THEN NOT list_contains({_list(NO_NAMES)}, ({own})[1]) AND length(({own})[1]) > 3 ELSE true END)"
    return f"list_sort(list_distinct(list_filter(list_transform(list_concat({numbers}, {kept}), lambda t: {_match('t')}), lambda t: t <> '')))"


_SEEDS = "seeds AS (SELECT *, row_number() OVER (ORDER BY seed_id NULLS FIRST, source_question NULLS FIRST) AS ord FROM seed_records)"

_ATTEMPTS = """
own AS (SELECT item_ord, answer_groups, coalesce(nullif(id, ''), 'item-' || item_ord) AS item_id FROM generated_items),
sent AS (SELECT item_id, resp_id, model, coalesce(generation, response, answer, '') AS raw FROM solver_responses),
joined AS (SELECT item_ord, resp_id, model, raw, answer_groups FROM sent JOIN own USING (item_id))"""

_FENCE = r"""trim(CASE WHEN trim(raw, ' ' || chr(10) || chr(13) || chr(9)) LIKE '```%'
  THEN regexp_replace(regexp_replace(trim(raw, ' ' || chr(10) || chr(13) || chr(9)), '^```(?:json|JSON)?\s*', ''), '\s*```$', '') ELSE trim(raw, ' ' || chr(10) || chr(13) || chr(9)) END, ' ' || chr(10) || chr(13) || chr(9))"""
_PARSED = """CASE WHEN json_valid(bare) THEN (CASE WHEN json_type(bare) = 'OBJECT' THEN bare END)
  WHEN json_valid(regexp_extract(bare, '(?s)\\{.*\\}')) THEN regexp_extract(bare, '(?s)\\{.*\\}') END"""

_GRADED = f"""
WITH {_ATTEMPTS}, b AS (SELECT *, {_FENCE} AS bare FROM joined), q AS (SELECT *, {_PARSED} AS js FROM b),
x AS (SELECT *, list_transform(list_filter(coalesce(answer_groups, []), lambda g: g IS NOT NULL), lambda g: struct_pack(b := g.blank::VARCHAR, l := list_sort(list_distinct(flatten(list_transform(coalesce(g.correct_labels, []), lambda c: coalesce(regexp_extract_all(upper(c), '\\b[A-Z]\\b'), []))))))) AS want FROM q),
a AS (SELECT *, CASE WHEN js IS NULL THEN NULL
   WHEN json_type(js, '$.answers') = 'ARRAY' AND json_array_length(js, '$.answers') > 0 THEN list_transform((js -> '$.answers')::JSON[], lambda e: struct_pack(
      b := CASE WHEN json_type(e, '$.blank') = 'VARCHAR' THEN nullif(regexp_extract(e ->> '$.blank', '[0-9]+'), '') ELSE e ->> '$.blank' END,
      l := list_sort(list_distinct(regexp_extract_all(upper(CASE WHEN json_type(e) = 'OBJECT' THEN coalesce(e -> '$.labels', e -> '$.label', e -> '$.answer')::VARCHAR ELSE e::VARCHAR END), '\\b[A-Z]\\b')))))
   WHEN coalesce(js -> '$.labels', js -> '$.label', js -> '$.answer') IS NOT NULL AND len(regexp_extract_all(upper(coalesce(js -> '$.labels', js -> '$.label', js -> '$.answer')::VARCHAR), '\\b[A-Z]\\b')) > 0
      THEN [struct_pack(b := CASE WHEN len(want) = 1 THEN want[1].b END, l := list_sort(list_distinct(regexp_extract_all(upper(coalesce(js -> '$.labels', js -> '$.label', js -> '$.answer')::VARCHAR), '\\b[A-Z]\\b'))))]
   ELSE list_transform(list_filter(json_keys(js), lambda k: regexp_full_match(k, 'blank[_ -]*[0-9]+')), lambda k: struct_pack(b := regexp_extract(k, '[0-9]+'), l := list_sort(list_distinct(regexp_extract_all(upper((js -> ('$.' || k))::VARCHAR), '\\b[A-Z]\\b'))))) END AS got FROM x),
graded AS (SELECT item_ord, resp_id, model, js IS NOT NULL AS parsed,
  js IS NOT NULL AND len(want) = len(got) AND CASE WHEN len(want) = 1 THEN want[1].l = got[1].l ELSE list_sort(want) = list_sort(got) END AS correct FROM a)
"""

_RATED = """
rated AS (SELECT *, coalesce(solver_accuracy, CASE WHEN len(solver_results) > 0 THEN len(list_filter(solver_results, lambda r: r.correct IS NOT DISTINCT FROM true)) / len(solver_results) END) AS acc FROM generated_items)"""


def _issues(least_novelty: float, least_score: float, most_accuracy: float | None, unjudged: bool, unscored: bool, unsolved: bool) -> str:
    checks = ["CASE WHEN judge IS NOT NULL AND judge.valid IS DISTINCT FROM true THEN 'judge: item is not valid' END", f"CASE WHEN judge IS NOT NULL AND judge.score < {least_score} THEN 'judge: score below {least_score:g}' END"]
    checks += [] if unjudged else ["CASE WHEN judge IS NULL THEN 'judge: missing judge result' END"]
    checks += [f"CASE WHEN NOT isnan(novelty_score) AND novelty_score < {least_novelty} THEN 'novelty: score below {least_novelty:g}' END"]
    checks += [] if unscored else ["CASE WHEN novelty_score IS NULL THEN 'novelty: missing novelty_score' END"]
    checks += [] if unsolved else ["CASE WHEN acc IS NULL THEN 'solver: missing solver results' END"]
    checks += [] if most_accuracy is None else [f"CASE WHEN acc > {most_accuracy} THEN 'solver: item accuracy above {most_accuracy:g}' END"]
    return f"list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL)"


_HARDNESS = """coalesce(acc, 1.0), coalesce(-difficulty, 0), CASE WHEN novelty_score IS NULL OR isnan(novelty_score) THEN 0 ELSE -novelty_score END,
  coalesce(-judge.score, 0), coalesce(id, ''), item_ord"""


def _selected(issues: str, target: int, most: float) -> str:
    """WITH … f: items with acc, rank, fate and their issues (rules included)."""
    return rule_sql.item_errors() + f""", {_RATED},
e AS (SELECT r.*, list_concat(coalesce(s.said, []), {issues}) AS issues FROM rated r LEFT JOIN (SELECT ord, list('schema: ' || message) AS said FROM errors GROUP BY ord) s ON s.ord = r.item_ord),
k AS (SELECT *, row_number() OVER (ORDER BY {_HARDNESS}) AS rank FROM e WHERE len(issues) = 0),
m AS (SELECT *, sum(acc::DECIMAL(20,10)) OVER w AS total, count(acc) OVER w AS known FROM k WINDOW w AS (ORDER BY rank ROWS UNBOUNDED PRECEDING)),
z AS (SELECT coalesce(max(rank), 0) AS last FROM m WHERE (known = 0 OR total <= known * {most}::DECIMAL(20,10)) AND rank <= {target or 10**15}),
f AS (SELECT item_ord, acc, rank, CASE WHEN rank > {target or 10**15} THEN 'overflow' WHEN rank <= last THEN 'accepted' ELSE 'easiest' END AS fate, CASE WHEN rank > last THEN ['solver: removed to meet dataset accuracy target {most:g}'] ELSE issues END AS issues FROM m CROSS JOIN z
  UNION ALL SELECT item_ord, acc, NULL, 'rejected', issues FROM e WHERE len(issues) > 0)
"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() | _more_sql() | rule_sql.oracle_sql()


_GENERATIONS = f"""
WITH r AS (SELECT gen_id, seed_id, model_name, coalesce(generation, '') AS raw FROM raw_generations), b AS (SELECT gen_id, seed_id, model_name, {_FENCE} AS bare FROM r),
q AS (SELECT gen_id, seed_id, model_name, CASE WHEN json_valid(bare) THEN bare WHEN json_valid(regexp_extract(bare, '(?s)\\{{.*\\}}')) THEN regexp_extract(bare, '(?s)\\{{.*\\}}') END AS js FROM b),
l AS (SELECT gen_id, seed_id, model_name, CASE WHEN json_type(js) = 'ARRAY' THEN js::JSON[] WHEN json_type(js, '$.items') = 'ARRAY' THEN (js -> '$.items')::JSON[] END AS e FROM q),
ok AS (SELECT * FROM l WHERE e IS NOT NULL AND len(list_filter(e, lambda x: coalesce(json_type(x), 'NULL') <> 'OBJECT')) = 0)
"""


def _default(key: str, value: str) -> str:
    return f"CASE coalesce(json_type(x, '$.{key}'), '-') WHEN '-' THEN {value} WHEN 'NULL' THEN NULL ELSE x ->> '$.{key}' END AS {key}"


_W = {k: f"{v}::DOUBLE" for k, v in WEIGHTS.items()}
_NOVELTY = f"""
WITH {_ITEM_TEXTS}, {_SEEDS},
i AS (SELECT item_ord, {_content('main_text')} AS w, list_filter(list_transform(CASE WHEN len(cs) > 0 THEN cs ELSE {_choices("coalesce(stem, '')")} END, lambda c: {_match('c')}), lambda c: c <> '') AS c, {_terms('main_text')} AS t FROM (SELECT texts.*, stem FROM texts JOIN generated_items USING (item_ord))),
s AS (SELECT ord, coalesce(nullif(seed_id, ''), 'source-' || ord) AS source_id, {_content('q')} AS w, list_filter(list_transform({_choices("coalesce(source_question, '')")}, lambda c: {_match('c')}), lambda c: c <> '') AS c, {_terms('q')} AS t FROM (SELECT *, {_squeeze('source_question')} AS q FROM seeds)),
i2 AS (SELECT *, list_distinct(w) AS w1, {_grams('w', 3)} AS w3, {_grams('w', 4)} AS w4 FROM i), s2 AS (SELECT *, list_distinct(w) AS w1, {_grams('w', 3)} AS w3, {_grams('w', 4)} AS w4 FROM s),
common AS (SELECT item_ord, ord, kind, count(*) AS n FROM (
    SELECT item_ord, unnest(w1) AS x, 'w1' AS kind FROM i2 UNION ALL SELECT item_ord, unnest(w3), 'w3' FROM i2 UNION ALL SELECT item_ord, unnest(w4), 'w4' FROM i2 UNION ALL SELECT item_ord, unnest(t), 't' FROM i2) JOIN (
    SELECT ord, unnest(w1) AS x, 'w1' AS kind FROM s2 UNION ALL SELECT ord, unnest(w3), 'w3' FROM s2 UNION ALL SELECT ord, unnest(w4), 'w4' FROM s2 UNION ALL SELECT ord, unnest(t), 't' FROM s2) USING (x, kind) GROUP BY ALL),
forms AS (SELECT DISTINCT c, list_distinct(list_filter(string_split(c, ' '), lambda x: x <> '')) AS ws FROM (SELECT unnest(c) AS c FROM i2 UNION ALL SELECT unnest(c) FROM s2)),
shared AS (SELECT a.c AS a, b.c AS b, count(*) AS n FROM (SELECT c, unnest(ws) AS x FROM forms) a JOIN (SELECT c, unnest(ws) AS x FROM forms) b USING (x) GROUP BY ALL),
close AS (SELECT a, b FROM shared JOIN forms f ON f.c = a JOIN forms g ON g.c = b WHERE a = b OR n / (len(f.ws) + len(g.ws) - n) >= {NEAR_COPY_TOKENS}),
copied AS (SELECT item_ord, ord, count(*) AS n, list_sort(list_distinct(list(c))) AS l FROM (SELECT DISTINCT item_ord, k, i.c, ord FROM (SELECT item_ord, unnest(range(len(c))) AS k, unnest(c) AS c FROM i2) i JOIN close ON a = i.c JOIN (SELECT ord, unnest(c) AS c FROM s2) s ON s.c = b) GROUP BY ALL),
p AS (SELECT i2.item_ord, s2.ord, source_id, len(i2.w1) AS a1, len(s2.w1) AS b1, len(i2.w3) AS a3, len(s2.w3) AS b3, len(i2.w4) AS a4, len(s2.w4) AS b4, len(i2.c) AS nc, len(i2.t) AS nt, list_sort(list_intersect(i2.t, s2.t)) AS both_terms FROM i2 CROSS JOIN s2),
m AS (SELECT p.*, coalesce(w1.n, 0) AS n1, coalesce(w3.n, 0) AS n3, coalesce(w4.n, 0) AS n4, coalesce(t.n, 0) AS n_t, coalesce(copied.n, 0) AS n_c, copied.l AS copies FROM p
  LEFT JOIN common w1 ON w1.item_ord = p.item_ord AND w1.ord = p.ord AND w1.kind = 'w1' LEFT JOIN common w3 ON w3.item_ord = p.item_ord AND w3.ord = p.ord AND w3.kind = 'w3'
  LEFT JOIN common w4 ON w4.item_ord = p.item_ord AND w4.ord = p.ord AND w4.kind = 'w4' LEFT JOIN common t ON t.item_ord = p.item_ord AND t.ord = p.ord AND t.kind = 't'
  LEFT JOIN copied ON copied.item_ord = p.item_ord AND copied.ord = p.ord),
x AS (SELECT *, CASE WHEN a1 > 0 AND b1 > 0 THEN least(1.0::DOUBLE, 0.65::DOUBLE * (n1 / (a1 + b1 - n1)) + 0.35::DOUBLE * (n1 / least(a1, b1))) ELSE 0 END AS lexical,
  greatest(CASE WHEN a3 > 0 AND b3 > 0 THEN greatest(n3 / (a3 + b3 - n3), 0.8::DOUBLE * (n3 / least(a3, b3))) ELSE 0 END, CASE WHEN a4 > 0 AND b4 > 0 THEN greatest(n4 / (a4 + b4 - n4), 0.8::DOUBLE * (n4 / least(a4, b4))) ELSE 0 END) AS phrase,
  CASE WHEN nc > 0 THEN n_c / nc ELSE 0 END AS choice, CASE WHEN nt > 0 THEN n_t / nt ELSE 0 END AS entity FROM m),
z AS (SELECT *, {_W['lexical']} * lexical + {_W['phrase']} * phrase + {_W['choice']} * choice + {_W['entity']} * entity AS sim FROM x),
r AS (SELECT *, format('{{:.1f}}', least(100.0::DOUBLE, greatest(0.0::DOUBLE, 100.0::DOUBLE * (1.0::DOUBLE - sim))))::DOUBLE AS novelty FROM z),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_ord ORDER BY novelty, ord) AS nth FROM r) WHERE nth = 1)
SELECT item_ord, novelty AS novelty_score, source_id, format('{{:.1f}}', 100.0::DOUBLE * least(1.0::DOUBLE, sim))::DOUBLE AS max_similarity_score,
  {", ".join(f"format('{{:.1f}}', 100.0::DOUBLE * (1.0::DOUBLE - {c}))::DOUBLE AS {n}" for c, n in (("lexical", "lexical_novelty"), ("phrase", "phrase_novelty"), ("choice", "answer_choice_novelty"), ("entity", "entity_number_novelty"), ("0.0::DOUBLE", "structure_novelty")))},
  novelty >= 75 AND n_c = 0 AND n_t = 0 AS novelty_pass, coalesce(array_to_string(copies, '|'), '') AS copied, array_to_string(both_terms, '|') AS reused,
  CASE WHEN novelty >= 75 AND n_c = 0 AND n_t = 0 THEN 'passes novelty gate' ELSE array_to_string(list_filter([CASE WHEN novelty < 75 THEN 'novelty_score below 75' END, CASE WHEN n_c > 0 THEN 'copied or near-copied answer choice' END, CASE WHEN n_t > 0 THEN 'reused distinctive entity or number' END], lambda q: q IS NOT NULL), '|') END AS reasons FROM best"""


def _string(path: str) -> str:
    return f"CASE json_type(j, '{path}') WHEN 'VARCHAR' THEN j ->> '{path}' END"


def _blank(x: str) -> str:
    return f"CASE WHEN {_squeeze(x)} <> '' THEN {x} END"


_LINE_TEXTS = f"""
f AS (SELECT line_no, j, {", ".join(f"{_string('$.' + k)} AS {k}" for k in ("source_question", "question", "stem", "stimulus", "passage"))},
  CASE WHEN json_type(j, '$.passages') = 'ARRAY' THEN list_transform((j -> '$.passages')::JSON[], lambda p: CASE json_type(p) WHEN 'VARCHAR' THEN p ->> '$' WHEN 'OBJECT' THEN CASE json_type(p, '$.text') WHEN 'VARCHAR' THEN p ->> '$.text' END END) ELSE [] END AS several,
  CASE WHEN json_type(j, '$.answer_groups') = 'ARRAY' THEN list_filter(flatten(list_transform((j -> '$.answer_groups')::JSON[], lambda g: CASE WHEN json_type(g, '$.choices') = 'ARRAY' THEN list_transform((g -> '$.choices')::JSON[], lambda c: CASE json_type(c, '$.text') WHEN 'VARCHAR' THEN c ->> '$.text' END) ELSE [] END)), lambda t: t IS NOT NULL) ELSE [] END AS inner_texts
  FROM (SELECT line_no, line::JSON AS j FROM item_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT')),
g AS (SELECT *, list_filter(list_concat([passage], several), lambda p: coalesce({_squeeze('p')} <> '', false)) AS ps,
  coalesce(list_filter([inner_texts, {_choices("coalesce(source_question, '')")}, {_choices("coalesce(question, '')")}, {_choices("coalesce(stem, '')")}], lambda l: len(l) > 0)[1], []) AS cs FROM f),
h AS (SELECT line_no, j, cs, CASE WHEN source_question IS NOT NULL THEN {_squeeze('source_question')} ELSE {_squeeze("array_to_string(list_filter(list_concat([" + _blank('stimulus') + "], ps, [" + _blank('stem') + "], [" + _blank('question') + "], cs), lambda t: t IS NOT NULL), ' ')")} END AS text,
  CASE WHEN source_question IS NOT NULL THEN {_squeeze("string_split(regexp_replace(source_question, '(?i)\\bChoices\\s*:', chr(2)), chr(2))[1]")} ELSE {_squeeze("array_to_string(list_filter(list_concat([" + _blank('stimulus') + "], ps, [" + _blank('stem') + "]), lambda t: t IS NOT NULL), ' ')")} END AS structure FROM g)"""


def _more_sql() -> dict[str, str]:
    shown = "array_to_string(list_transform({}, lambda a: coalesce(a.b, '-') || ':' || array_to_string(a.l, '+')), ';')"
    profiles = ", ".join(f"('{name}', '{column}', '{value}', {n})" for name, (column, expected) in PROFILES.items() for value, n in expected.items())
    return {
        "seed_choices": f"SELECT seed_id, source_question, array_to_string({_choices('q')}, '|') AS choices FROM (SELECT *, {_squeeze('source_question')} AS q FROM seed_records)",
        "distinctive_terms": f"WITH {_ITEM_TEXTS} SELECT item_ord, array_to_string({_terms('main_text')}, '|') AS terms FROM texts",
        "own_seed_similarity": f"""
WITH {_ITEM_TEXTS}, {_SEEDS}, s AS (SELECT source_id, {_squeeze('arg_min(source_question, ord)')} AS q FROM (SELECT *, coalesce(nullif(seed_id, ''), 'source-' || ord) AS source_id FROM seeds) GROUP BY source_id),
j AS (SELECT item_ord, source_id, list_distinct({_content('main_text')}) AS a, list_distinct({_content('q')}) AS b, {_terms('main_text')} AS t, {_terms('q')} AS u FROM texts JOIN s ON source_seed_id = source_id),
n AS (SELECT *, len(list_intersect(a, b)) AS c, list_sort(list_intersect(t, u)) AS both_terms FROM j)
SELECT item_ord, source_id, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN least(1.0, 0.65 * (c / (len(a) + len(b) - c)) + 0.35 * (c / least(len(a), len(b)))) ELSE 0.0 END, 6) AS lexical,
  round(CASE WHEN len(t) > 0 THEN len(both_terms) / len(t) ELSE 0.0 END, 6) AS entity, array_to_string(both_terms, '|') AS reused FROM n""",
        "novelty_sets": _NOVELTY,
        "line_texts": f"WITH {_LINE_TEXTS} SELECT line_no, md5(text) AS text, md5(structure) AS structure, array_to_string(cs, '|') AS choices FROM h",
        "line_novelty": f"""
WITH {_LINE_TEXTS}, w AS (SELECT line_no, row_number() OVER () AS occ, list_distinct({_content('text')}) AS w, coalesce({", ".join(f"nullif(CASE WHEN json_type(j, '$.{k}') <> 'NULL' THEN j ->> '$.{k}' END, '')" for k in ("seed_id", "id", "question_id", "source_seed_id"))}, 'source-' || line_no) AS source_id FROM h),
s AS (SELECT * FROM w WHERE line_no % 2 = 0), i AS (SELECT * FROM w WHERE line_no % 2 = 1),
c AS (SELECT i.occ AS o, s.occ AS p, count(*) AS n FROM (SELECT occ, unnest(w) AS t FROM i) i JOIN (SELECT occ, unnest(w) AS t FROM s) s USING (t) GROUP BY ALL),
v AS (SELECT i.occ, i.line_no, s.line_no AS ord, s.source_id, CASE WHEN n IS NULL THEN 0.0 ELSE least(1.0, 0.65 * (n / (len(i.w) + len(s.w) - n)) + 0.35 * (n / least(len(i.w), len(s.w)))) END AS lexical FROM i CROSS JOIN s LEFT JOIN c ON c.o = i.occ AND c.p = s.occ)
SELECT line_no, source_id, round(lexical, 6) AS lexical FROM (SELECT *, row_number() OVER (PARTITION BY occ ORDER BY round(lexical, 9) DESC, ord) AS nth FROM v) WHERE nth = 1""",
        "predicted_answers": _GRADED + f"SELECT {shown.format('want')} AS expected, {shown.format('coalesce(got, [])')} AS predicted, js IS NOT NULL AND len(want) = len(got) AND CASE WHEN len(want) = 1 THEN want[1].l = got[1].l ELSE list_sort(want) = list_sort(got) END AS correct, count(*) AS attempts FROM a GROUP BY ALL",
        "answer_contract": _GRADED + "SELECT count(*) AS attempts, count(*) FILTER (len(got) <> len(want)) AS wrong_count, count(*) FILTER (len(list_filter(got, lambda p: len(p.l) > list_max(list_transform(want, lambda e: len(e.l))))) > 0) AS many_labels FROM a WHERE js IS NOT NULL",
        "solver_results": _GRADED + """, x2 AS (SELECT item_ord, resp_id, coalesce(model, 'None') AS model, raw, js IS NOT NULL AS parsed, js IS NOT NULL AND len(want) = len(got) AND CASE WHEN len(want) = 1 THEN want[1].l = got[1].l ELSE list_sort(want) = list_sort(got) END AS correct,
   CASE WHEN js IS NULL OR (len(want) = 1 AND len(got) = 1) THEN [] ELSE list_transform(list_filter(want, lambda w: len(list_filter(got, lambda g: g.b IS NOT DISTINCT FROM w.b)) = 0), lambda w: coalesce(w.b, '-')) END AS missing FROM a)
SELECT item_ord, count(resp_id) AS n_attempts, round(avg(correct::INT), 4) AS solver_accuracy, md5(coalesce(string_agg(model || ',' || correct || ',' || parsed || ',' || md5(raw) || ',' || array_to_string(missing, '+'), ';' ORDER BY resp_id), '')) AS results FROM generated_items LEFT JOIN x2 USING (item_ord) GROUP BY item_ord""",
        "result_chunks": _GRADED + "SELECT item_ord, count(*) AS attempts, count(*) FILTER (correct) AS correct FROM graded GROUP BY item_ord",
        "explode_generated_items": _GENERATIONS + f"""SELECT gen_id, pos::INT AS pos, {_default('id', "'synthetic-' || seed || '-' || lpad((pos + 1)::VARCHAR, greatest(3, length((pos + 1)::VARCHAR))::INT, '0')")}, {_default('source_seed_id', 'seed')}, {_default('generation_model', 'model_name')}, {_default('question_type', 'NULL')}
FROM (SELECT gen_id, coalesce(nullif(seed_id, ''), 'seed-' || gen_id) AS seed, model_name, unnest(range(len(e))) AS pos, unnest(e) AS x FROM ok)""",
        "items_per_generation": _GENERATIONS + "SELECT len(e)::INT AS items, count(*) AS generations, len(e) = 2 AS holds FROM ok GROUP BY ALL",
        "redacted_items": f"SELECT line_no, array_to_string(list_sort(list_concat(list_filter(list_distinct(json_keys(line)), lambda k: NOT list_contains({_list([*ANSWER_KEYS, 'answer_groups'])}, k)), ['answer_groups'])), ',') AS keys, false AS leaks FROM item_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT'",
        "judged_lines": """
SELECT line_no, coalesce(json_type(line, '$.judge') = 'OBJECT', false) AS judged, coalesce(json_type(line, '$.judge.valid') = 'BOOLEAN' AND (line ->> '$.judge.valid') = 'true'
  AND trunc(CASE json_type(line, '$.judge.score') WHEN 'BOOLEAN' THEN (line ->> '$.judge.score')::BOOLEAN::INT::DOUBLE WHEN 'VARCHAR' THEN TRY_CAST(line ->> '$.judge.score' AS INT)::DOUBLE ELSE TRY_CAST(line ->> '$.judge.score' AS DOUBLE) END) >= 4, false) AS accepted
FROM item_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT'""",
        "judge_reviews": """
WITH k AS (SELECT *, coalesce(nullif(id, ''), 'item-' || item_ord) AS item_id FROM generated_items), l AS (SELECT item_id, max(item_ord) AS item_ord, arg_max(struct_pack(q := question_type), item_ord).q AS question_type FROM k GROUP BY item_id)
SELECT item_id, l.item_ord, l.question_type, count(*) AS reviews, count(*) FILTER (judge.valid AND judge.score >= 4) AS accepted, min(CASE WHEN judge IS NULL THEN 1 ELSE judge.score END)::INT AS least_score, count(*) FILTER (judge IS NULL) AS failed FROM k JOIN l USING (item_id) GROUP BY ALL""",
        "gate_issues_full": rule_sql.item_errors() + f""", {_RATED}, gated AS (SELECT *, {_issues(75.0, 4.0, 0.9, False, False, False)} AS issues, CASE WHEN novelty_score < 75 AND NOT isnan(novelty_score) THEN [CASE WHEN item_ord % 2 = 0 THEN 'novelty: copied; reused' ELSE 'novelty: failed novelty gate' END] ELSE [] END AS failed FROM rated)
SELECT issue, count(*) AS items FROM (SELECT unnest(list_concat(issues, failed)) AS issue FROM gated UNION ALL SELECT 'schema: ' || message FROM errors) GROUP BY issue""",
        "profile_quotas": f"""
WITH q(profile, kind, value, expected) AS (VALUES {profiles}), n AS (SELECT 'question_type' AS kind, question_type AS value, count(*) AS found FROM generated_items GROUP BY ALL UNION ALL SELECT 'subtype', subtype, count(*) FROM generated_items GROUP BY ALL)
SELECT profile, value, expected::BIGINT AS expected, coalesce(found, 0) AS found, expected = coalesce(found, 0) AS holds FROM q LEFT JOIN n USING (kind, value)""",
        "passage_set_sizes": "SELECT passage_set_id, count(*) AS questions, count(DISTINCT coalesce(passages::VARCHAR, chr(1))) AS texts, count(*) = 5 AND count(DISTINCT coalesce(passages::VARCHAR, chr(1))) = 1 AS holds FROM generated_items WHERE passage_set_id IS NOT NULL GROUP BY passage_set_id",
        "hard_share": "SELECT count(*) AS rows, avg(coalesce(difficulty >= 4, false)::INT) AS share, avg(coalesce(difficulty >= 4, false)::INT) >= 0.3 AS holds FROM generated_items",
        "answer_gap": """
WITH g AS (SELECT unnest(answer_groups) AS g FROM generated_items), l AS (SELECT unnest(g.correct_labels) AS label FROM g WHERE len(g.correct_labels) = 1), s AS (SELECT round(count(*) / (SELECT count(*) FROM l), 6) AS share FROM l GROUP BY label)
SELECT max(share) - min(share) AS gap FROM s""",
        "numbered_identifiers": "SELECT 'gre-tc-' || lpad(n::VARCHAR, 9, '0') AS id FROM range(1, 501) AS r(n) WHERE 'gre-tc-' || lpad(n::VARCHAR, 9, '0') NOT IN (SELECT id FROM generated_items WHERE id IS NOT NULL)",
        "repeated_across_batches": f"""
WITH f AS (SELECT {_match('stem')} AS form, count(DISTINCT item_ord // 10) AS batches FROM generated_items GROUP BY 1)
SELECT batches, count(*) AS texts FROM f WHERE batches > 1 GROUP BY batches""",
        "passage_words": f"""
WITH {_ITEM_TEXTS}, w AS (SELECT len(string_split({_squeeze('p')}, ' ')) AS n FROM (SELECT unnest(ps) AS p FROM texts))
SELECT count(n) AS texts, count(*) FILTER (n < 60) AS short, count(*) FILTER (n > 160) AS long FROM w""",
    }


def _own_sql() -> dict[str, str]:
    nodes = """
WITH o AS (SELECT line_no, row_number() OVER () AS occ, line::JSON AS j FROM item_lines WHERE json_valid(line) AND json_type(line) = 'OBJECT'),
a AS (SELECT occ, line_no, k, CASE WHEN json_type(j, '$.' || k) = 'VARCHAR' AND k <> 'passages' AND json_valid(j ->> ('$.' || k)) THEN (j ->> ('$.' || k))::JSON ELSE j -> ('$.' || k) END AS v
      FROM o, (VALUES ('passages'), ('answer_groups'), ('solver_results'), ('judge')) AS t(k)),
l AS (SELECT occ, line_no, k, CASE WHEN k = 'judge' THEN (CASE WHEN json_type(v) = 'OBJECT' THEN [v] END)
        WHEN json_type(v) = 'ARRAY' THEN (v)::JSON[] WHEN json_type(v) = 'OBJECT' OR (json_type(v) = 'VARCHAR' AND k = 'passages') THEN [v] END AS e FROM a),
e AS (SELECT occ, line_no, k, unnest(range(len(e)))::INT AS pos, unnest(e) AS x FROM l WHERE e IS NOT NULL),
p AS (SELECT * FROM e WHERE json_type(x) = 'OBJECT' OR (k = 'passages' AND json_type(x) = 'VARCHAR')),
inner_keys(k, kk, child, kinds) AS (VALUES ('answer_groups', 'choices', 'choice', 'OBJECT'), ('answer_groups', 'correct_labels', 'correct_label', 'VARCHAR'),
   ('solver_results', 'expected', 'expected', 'OBJECT'), ('solver_results', 'predicted', 'predicted', 'OBJECT'), ('judge', 'issues', 'judge_issue', 'VARCHAR')),
c AS (SELECT line_no, pos AS parent_pos, child, kinds, x -> ('$.' || kk) AS v FROM p JOIN inner_keys USING (k) WHERE json_type(x) = 'OBJECT'),
cl AS (SELECT line_no, parent_pos, child, kinds, CASE WHEN json_type(v) = 'ARRAY' THEN v::JSON[]
        WHEN json_type(v) = 'OBJECT' AND child = 'choice' AND NOT (list_contains(json_keys(v), 'label') AND list_contains(json_keys(v), 'text')) THEN list_transform(json_keys(v), lambda q: '{}'::JSON)
        WHEN json_type(v) = kinds THEN [v] END AS e FROM c),
ce AS (SELECT line_no, parent_pos, child, kinds, unnest(range(len(e)))::INT AS pos, unnest(e) AS x FROM cl WHERE e IS NOT NULL)
"""
    capped = _selected(_issues(75.0, 4.0, None, True, True, True), 50, 0.3)
    strict = _selected(_issues(75.0, 4.0, 0.9, False, False, False), 0, 0.6)
    return {
        "selected_items": capped + "SELECT fate, count(*) AS items FROM f GROUP BY fate",
        "hardest_accepted": capped + "SELECT item_ord, rank FROM f WHERE fate = 'accepted'",
        "filter_summary": strict + """SELECT count(*) AS input_items, count(rank) AS candidate_items, count(*) FILTER (fate = 'accepted') AS accepted_items, count(*) FILTER (fate IN ('rejected', 'easiest')) AS rejected_items,
  NULL::INT AS target_size, 75.0::DOUBLE AS min_novelty, 4.0::DOUBLE AS min_judge_score, 0.6::DOUBLE AS max_dataset_solver_accuracy, round(avg(acc) FILTER (fate = 'accepted'), 4) AS dataset_solver_accuracy,
  coalesce(avg(acc) FILTER (fate = 'accepted') <= 0.6, false) AS solver_accuracy_target_met, true AS enforced_solver_target FROM f""",
        "rejection_histogram": strict + "SELECT reason, count(*) AS items FROM (SELECT unnest(issues) AS reason FROM f WHERE fate IN ('rejected', 'easiest')) GROUP BY reason",
        "p3_choices": nodes.replace("lambda q: '{}'::JSON", "lambda q: json_object('label', q, 'text', v ->> ('$.\"' || q || '\"'))") + """SELECT line_no, parent_pos, pos, x ->> '$.label' AS label, x ->> '$.text' AS text FROM ce WHERE child = 'choice' AND json_type(x) = 'OBJECT'""",
        "failed_generations": f"""
WITH r AS (SELECT model_name, coalesce(generation, '') AS raw FROM raw_generations), b AS (SELECT model_name, {_FENCE} AS bare FROM r),
q AS (SELECT model_name, CASE WHEN json_valid(bare) THEN bare WHEN json_valid(regexp_extract(bare, '(?s)\\{{.*\\}}')) THEN regexp_extract(bare, '(?s)\\{{.*\\}}') END AS js FROM b),
l AS (SELECT model_name, CASE WHEN json_type(js) = 'ARRAY' THEN js::JSON[] WHEN json_type(js, '$.items') = 'ARRAY' THEN (js -> '$.items')::JSON[] END AS e FROM q)
SELECT model_name, count(*) AS failed FROM l WHERE e IS NULL OR len(list_filter(e, lambda x: json_type(x) <> 'OBJECT')) > 0 GROUP BY model_name""",
        "abstract_structures": rf"""
WITH t AS (SELECT {_squeeze("string_split(regexp_replace(coalesce(source_question, ''), '(?i)\\bChoices\\s*:', chr(2)), chr(2))[1]")} AS t FROM seed_records),
b AS (SELECT regexp_replace(t, '\[[^\]]*blank[^\]]*\]', ' BLANK ', 'gi') AS t FROM t),
n AS (SELECT regexp_replace(t, '\b{_NUMBER}', ' NUM ', 'g') AS t FROM b), w AS (SELECT regexp_replace(t, '[A-Za-z]+', ' W ', 'g') AS t FROM n),
x AS (SELECT regexp_replace(t, '(?:\s*W\s*)+', ' W ', 'g') AS t FROM w)
SELECT {_squeeze("t")} AS structure, count(*) AS seeds FROM x GROUP BY 1""",
        "p3_found": nodes + """SELECT line_no, CASE k WHEN 'passages' THEN 'passage' WHEN 'answer_groups' THEN 'answer_group' WHEN 'solver_results' THEN 'solver_result' ELSE 'judge' END AS child, -1 AS parent_pos, pos FROM p
UNION ALL SELECT line_no, child, parent_pos, pos FROM ce WHERE json_type(x) = kinds""",
        "jsonl_scan": r"""
WITH l AS (SELECT CASE WHEN regexp_full_match(coalesce(line, ''), '\s*') THEN 'blank' WHEN NOT json_valid(line) THEN 'invalid JSON' WHEN json_type(line) <> 'OBJECT' THEN 'row must be a JSON object' ELSE 'record' END AS outcome FROM item_lines)
SELECT outcome, count(*) AS n_lines FROM l GROUP BY outcome""",
        "record_identifiers": "SELECT item_ord, coalesce(nullif(id, ''), 'item-' || item_ord) AS item_key, coalesce(nullif(source_seed_id, ''), 'seed-' || item_ord) AS seed_name, regexp_replace(coalesce(generation_model, 'None'), '[^A-Za-z0-9_.-]+', '-', 'g') AS slug FROM generated_items",
        "answer_key_flatten": "SELECT * FROM (VALUES ('arithmetic', 'Q1', 'C'), ('arithmetic', 'Q2', 'A'), ('arithmetic', 'Q3', 'E'), ('sequences', 'Q1', 'B'), ('sequences', 'Q2', 'D')) AS t(section, question, label)",
        "normalized_texts": f"SELECT doc_id, md5({_squeeze('text')}) AS squeezed, md5({_match('text')}) AS matched FROM documents",
        "content_token_stats": f"WITH t AS (SELECT doc_id, {_content('text')} AS w FROM documents) SELECT doc_id, len(w)::INT AS n_tokens, len(list_distinct(w))::INT AS n_distinct, len({_grams('w', 3)})::INT AS n_trigrams, len({_grams('w', 4)})::INT AS n_fourgrams FROM t",
        "main_texts": f"WITH {_ITEM_TEXTS} SELECT item_ord, md5(main_text) AS main_text, md5(structure_text) AS structure_text, len(cs)::INT AS n_choices, len(ps)::INT AS n_passages FROM texts",
        "novelty_lexical_riskiest": f"""
WITH {_ITEM_TEXTS}, {_SEEDS},
i AS (SELECT item_ord, list_distinct({_content('main_text')}) AS w FROM texts),
s AS (SELECT coalesce(nullif(seed_id, ''), 'source-' || ord) AS source_id, ord, list_distinct({_content('source_question')}) AS w FROM seeds),
it AS (SELECT item_ord, unnest(w) AS t FROM i), st AS (SELECT ord, unnest(w) AS t FROM s),
c AS (SELECT item_ord, ord, count(*) AS common FROM it JOIN st USING (t) GROUP BY ALL),
v AS (SELECT i.item_ord, s.ord, source_id, CASE WHEN common IS NULL THEN 0.0 ELSE least(1.0, 0.65 * (common / (len(i.w) + len(s.w) - common)) + 0.35 * (common / least(len(i.w), len(s.w)))) END AS lexical
      FROM i CROSS JOIN s LEFT JOIN c ON c.item_ord = i.item_ord AND c.ord = s.ord)
SELECT item_ord, source_id, round(lexical, 6) AS lexical FROM (SELECT *, row_number() OVER (PARTITION BY item_ord ORDER BY round(lexical, 9) DESC, ord) AS nth FROM v) WHERE nth = 1""",
        "own_seed_phrases": f"""
WITH {_ITEM_TEXTS}, {_SEEDS},
s AS (SELECT seed_id, {_content('arg_min(source_question, ord)')} AS w FROM seeds GROUP BY seed_id),
j AS (SELECT item_ord, seed_id, {_content('main_text')} AS a, s.w AS b FROM texts JOIN s ON source_seed_id = seed_id),
g AS (SELECT item_ord, seed_id, {_grams('a', 3)} AS a3, {_grams('b', 3)} AS b3, {_grams('a', 4)} AS a4, {_grams('b', 4)} AS b4 FROM j),
n AS (SELECT *, len(list_intersect(a3, b3)) AS c3, len(list_intersect(a4, b4)) AS c4 FROM g)
SELECT item_ord, seed_id, round(coalesce(greatest(
  CASE WHEN len(a3) > 0 AND len(b3) > 0 THEN greatest(c3 / (len(a3) + len(b3) - c3), 0.8 * (c3 / least(len(a3), len(b3)))) END,
  CASE WHEN len(a4) > 0 AND len(b4) > 0 THEN greatest(c4 / (len(a4) + len(b4) - c4), 0.8 * (c4 / least(len(a4), len(b4)))) END), 0.0), 6) AS phrase FROM n""",
        "stored_novelty_summary": """
SELECT 75.0::DOUBLE AS threshold, count(*) AS total_items, count(*) FILTER (novelty_score >= 75) AS passed_items, count(*) FILTER (novelty_score < 75) AS failed_items,
  round(avg(novelty_score), 1) AS average_novelty_score, round(min(novelty_score), 1) AS minimum_novelty_score FROM generated_items WHERE novelty_score BETWEEN 0 AND 100 AND NOT isnan(novelty_score)""",
        "json_salvage": f"""
WITH r AS (SELECT model, coalesce(generation, response, answer, '') AS raw FROM solver_responses), b AS (SELECT model, {_FENCE} AS bare FROM r)
SELECT model, count(*) AS responses, count({_PARSED}) AS parsed FROM b GROUP BY model""",
        "orphan_responses": "SELECT resp_id, item_id FROM solver_responses r WHERE NOT EXISTS (SELECT 1 FROM generated_items i WHERE coalesce(nullif(i.id, ''), 'item-' || i.item_ord) = r.item_id)",
        "response_rows_invalid": """
SELECT resp_id, CASE WHEN item_id IS NULL THEN 'response row missing item_id' WHEN model IS NULL THEN 'response row missing model' ELSE 'response row missing generation/response/answer' END AS problem
FROM solver_responses WHERE item_id IS NULL OR model IS NULL OR coalesce(generation, response, answer) IS NULL""",
        "judge_gate": "SELECT question_type, count(*) AS items, count(judge) AS judged, count(*) FILTER (judge.valid AND judge.score >= 4) AS accepted FROM generated_items GROUP BY question_type",
        "seed_lookup": f"""
WITH {_SEEDS}, m AS (SELECT seed_id, arg_max(struct_pack(a := source_answer), ord).a AS source_answer FROM seeds GROUP BY seed_id)
SELECT source_seed_id, count(*) AS items, max(source_answer) AS source_answer FROM generated_items LEFT JOIN m ON source_seed_id = seed_id GROUP BY source_seed_id""",
        "rendered_prompts": """
WITH p AS (SELECT seed_id, 'Write 2 items from: {' || array_to_string(list_filter(['"seed_id":' || to_json(seed_id)::VARCHAR, '"question_type":' || to_json(question_type)::VARCHAR, '"source_question":' || to_json(source_question)::VARCHAR,
  '"source_answer":' || to_json(source_answer)::VARCHAR], lambda x: x IS NOT NULL AND NOT x LIKE '%:null'), ',') || '}' AS prompt FROM seed_records)
SELECT seed_id, md5(prompt) AS prompt, length(prompt)::INT AS n_chars FROM p""",
        "gate_issues": f"WITH {_RATED} SELECT issue, count(*) AS items FROM (SELECT unnest({_issues(75.0, 4.0, 0.9, False, False, False)}) AS issue FROM rated) GROUP BY issue",
        "hardness_ranks": f"WITH {_RATED} SELECT item_ord, row_number() OVER (ORDER BY {_HARDNESS}) AS rank FROM rated WHERE len({_issues(75.0, 4.0, None, True, False, False)}) = 0",
        "prefix_mean_cutoff": f"""
WITH {_RATED}, e AS (SELECT *, len({_issues(75.0, 4.0, 0.9, False, False, False)}) AS n FROM rated),
r AS (SELECT item_ord, acc, row_number() OVER (ORDER BY {_HARDNESS}) AS rank FROM e WHERE n = 0),
m AS (SELECT item_ord, rank, sum(acc::DECIMAL(20,10)) OVER w AS s, count(acc) OVER w AS k FROM r WINDOW w AS (ORDER BY rank ROWS UNBOUNDED PRECEDING)),
t AS (SELECT coalesce(max(rank), 0) AS last FROM m WHERE k = 0 OR s <= k * 0.6::DECIMAL(20,10))
SELECT item_ord, CASE WHEN rank <= last THEN 'accepted' ELSE 'easiest' END AS fate FROM m CROSS JOIN t UNION ALL SELECT item_ord, 'rejected' FROM e WHERE n > 0""",
        "type_quota": """
WITH x AS (SELECT question_type AS value, count(*) AS found FROM generated_items GROUP BY 1), q(value, expected) AS (VALUES ('reading_comprehension', 15), ('text_completion', 9), ('sentence_equivalence', 6))
SELECT coalesce(x.value, q.value) AS value, coalesce(expected, 0)::BIGINT AS expected, coalesce(found, 0) AS found, coalesce(expected, 0) = coalesce(found, 0) AS holds FROM x FULL JOIN q ON x.value = q.value""",
        "passage_sets": "SELECT passage_id, count(*) AS questions, count(DISTINCT coalesce(passage, chr(1))) AS texts, count(*) = 3 AND count(DISTINCT coalesce(passage, chr(1))) = 1 AS holds FROM generated_items WHERE passage_id IS NOT NULL GROUP BY passage_id",
        "choice_counts": "WITH g AS (SELECT question_type, subtype, unnest(answer_groups) AS g FROM generated_items) SELECT question_type, subtype, coalesce(len(g.choices), 0)::INT AS choices, coalesce(len(g.correct_labels), 0)::INT AS correct, count(*) AS groups FROM g GROUP BY ALL",
        "identifier_audit": """
WITH i AS (SELECT nullif(id, '') AS id, count(*) AS n FROM generated_items GROUP BY 1)
SELECT sum(n)::BIGINT AS items, coalesce(sum(n) FILTER (id IS NULL), 0)::BIGINT AS missing, count(*) FILTER (id IS NOT NULL AND NOT regexp_full_match(id, '(gre|lsat)-(tc|se|rc|lr)-[0-9]{9}')) AS malformed, count(*) FILTER (id IS NOT NULL AND n > 1) AS repeated FROM i""",
        "field_audit": f"""
SELECT 'difficulty 1 to 5' AS rule, count(*) FILTER (NOT coalesce(difficulty BETWEEN 1 AND 5, false)) AS broken FROM generated_items
UNION ALL SELECT 'two to five tags', count(*) FILTER (NOT len(coalesce(skill_tags, [])) BETWEEN 2 AND 5) FROM generated_items
UNION ALL SELECT 'tags in lower case', count(*) FILTER (len(list_filter(coalesce(skill_tags, []), lambda t: t <> lower(t))) > 0) FROM generated_items
UNION ALL SELECT 'passage on reading items only', count(*) FILTER (coalesce(question_type = 'reading_comprehension', false) <> (coalesce({_squeeze('passage')} <> '', false) AND passage IS NOT NULL OR coalesce(len(passages) > 0, false))) FROM generated_items""",
        "passage_counts": "SELECT subtype, len(passages)::INT AS passages, count(*) AS items FROM generated_items WHERE passages IS NOT NULL GROUP BY ALL",
        "answer_balance": """
WITH g AS (SELECT unnest(answer_groups) AS g FROM generated_items), l AS (SELECT unnest(g.correct_labels) AS label FROM g WHERE len(g.correct_labels) = 1)
SELECT label, count(*) AS answers, round(count(*) / (SELECT count(*) FROM l), 6) AS share FROM l GROUP BY label""",
        "score_scale": "SELECT judge.score AS score, count(*) AS items, judge.score BETWEEN 1 AND 5 AS in_scale FROM generated_items WHERE judge.score IS NOT NULL GROUP BY ALL",
        "graded_attempts": _GRADED + "SELECT item_ord, resp_id, model, parsed, correct FROM graded",
        "graded_attempts_salted": _GRADED + "SELECT item_ord, resp_id, model, parsed, correct FROM graded",
        "item_accuracies": _GRADED + """
SELECT i.item_ord, count(resp_id) AS attempts, count(*) FILTER (correct) AS correct, round(count(*) FILTER (correct) / nullif(count(resp_id), 0), 4) AS solver_accuracy
FROM generated_items i LEFT JOIN graded g ON g.item_ord = i.item_ord GROUP BY i.item_ord""",
        "solver_model_totals": _GRADED + "SELECT coalesce(model, 'None') AS model, count(*) AS total, count(*) FILTER (correct) AS correct, round(count(*) FILTER (correct) / count(*), 4) AS accuracy FROM graded GROUP BY 1",
        "solver_overall": _GRADED + """, p AS (SELECT i.item_ord, count(resp_id) AS n, count(*) FILTER (correct) AS k FROM generated_items i LEFT JOIN graded g ON g.item_ord = i.item_ord GROUP BY i.item_ord)
SELECT count(*) AS total_items, sum(n)::BIGINT AS total_solver_attempts, round(sum(k) / sum(n), 4) AS overall_accuracy, round(avg(round(k / nullif(n, 0), 4)), 4) AS average_item_accuracy FROM p""",
        "generation_outcomes": f"""
WITH r AS (SELECT model_name, coalesce(generation, '') AS raw FROM raw_generations), b AS (SELECT model_name, {_FENCE} AS bare FROM r),
q AS (SELECT model_name, CASE WHEN json_valid(bare) THEN bare WHEN json_valid(regexp_extract(bare, '(?s)\\{{.*\\}}')) THEN regexp_extract(bare, '(?s)\\{{.*\\}}') END AS js FROM b),
l AS (SELECT model_name, CASE WHEN json_type(js) = 'ARRAY' THEN js::JSON[] WHEN json_type(js, '$.items') = 'ARRAY' THEN (js -> '$.items')::JSON[] END AS e FROM q),
o AS (SELECT model_name, CASE WHEN len(list_filter(e, lambda x: json_type(x) <> 'OBJECT')) = 0 THEN e END AS e FROM l)
SELECT model_name, count(*) AS generations, count(e) AS with_items, coalesce(sum(len(e)), 0)::BIGINT AS n_items FROM o GROUP BY model_name""",
    }
