"""Reading answers out of model responses and grading them.

An answer is STRUCT<blank STRING, labels ARRAY<STRING>>: blank numbers are written as text ("1"), labels
are single capital letters, sorted and distinct. A response is read once, in Arrow batches, where it
is stored; grading against the answers expected is a Column expression after the join.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.functions import variants as V
from examsift.operators.sizing import HOT_ROWS, SALTS, broadcast_if_small, flag_hot, hot_keys

#: Attempts a chunk of an item's results holds, about.
MOST_IN_ARRAY = 10_000

#: Keys under which labels stand, and those under which lists of answers stand, in order of preference.
LABEL_KEYS = ["labels", "label", "answer", "answers", "correct_labels"]
LIST_KEYS = ["answers", "answer_groups", "responses"]
SINGLE_KEYS = ["labels", "label", "answer"]

RESULTS = "array<struct<model:string,raw_response:string,parsed_answer:string,parse_error:string,correct:boolean,expected:array<struct<blank:string,labels:array<string>>>,predicted:array<struct<blank:string,labels:array<string>>>,missing_blanks:array<string>>>"
ANSWERS = "array<struct<blank:string,labels:array<string>>>"
_ANSWERS = T.ArrayType(T.StructType([T.StructField("blank", T.StringType()), T.StructField("labels", T.ArrayType(T.StringType()))]))
#: What is read out of a response; ``at_top`` tells labels that stand without a list or blank.
READ = T.StructType([T.StructField("parse_error", T.StringType()), T.StructField("parsed_answer", T.StringType()), T.StructField("at_top", T.BooleanType()), T.StructField("answers", _ANSWERS)])

LETTER = re.compile(r"\b[A-Z]\b")
DIGITS = re.compile(r"\d+")
BLANK_KEY = re.compile(r"blank[_\s-]*(\d+)")
FENCE = re.compile(r"```(?:json)?\s*(.*?)\s*(?:```)?", re.I | re.S)


def unfence(text: Column) -> Column:
    """Text without white space around it and without a Markdown code fence."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    opened = F.regexp_replace(F.regexp_replace(bare, r"(?Ui)^```(?:json)?\s*", ""), r"(?U)\s*```$", "")
    return F.regexp_replace(F.when(bare.startswith("```"), opened).otherwise(bare), r"(?U)^\s+|\s+$", "")


def salvage(text: Column, only_objects: bool = True) -> Column:
    """VARIANT of the JSON in a text: the whole of it, else what stands from the first { to the last }.

    NULL if there is none, or, with ``only_objects``, if it is not an object.
    """
    bare = unfence(text)
    inner = F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))
    found = F.coalesce(V.parse(bare), V.parse(inner))
    return F.when(V.is_object(found), found) if only_objects else found


# --- reading in Python, once per response


def labels_in(value: Any) -> list[str]:
    """Labels in a value, at any depth: standing single letters of a text (whatever their case), of all elements of a
    list, or of the first label key of an object; sorted and distinct."""
    found: set[str] = set()
    left = [value]
    while left:
        x = left.pop()
        if isinstance(x, str):
            found.update(LETTER.findall(x.upper()))
        elif isinstance(x, list):
            left += x
        elif isinstance(x, dict):
            left += [x[k] for k in LABEL_KEYS if k in x][:1]
    return sorted(found)


def blank_name(value: Any) -> str | None:
    """Number of a blank as text; None for none. The first digits of a text count, else its lower case."""
    if isinstance(value, bool):
        return str(int(value))
    if value is None or isinstance(value, int):
        return None if value is None else str(value)
    text = (value if isinstance(value, str) else json.dumps(value)).strip().lower()
    digits = DIGITS.search(text)
    return str(int(digits[0])) if digits else None if text in ("", "null", "none") else text


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def parse_response(text: str) -> dict:
    """The JSON object of a response: the whole text (without a code fence), else what stands from the first { to the
    last }. Raises ValueError with the reason."""
    bare = text.strip()
    if bare.startswith("```"):
        bare = FENCE.fullmatch(bare)[1].strip()
    try:
        found = json.loads(bare, parse_constant=_no_constant)
    except ValueError:
        first, last = bare.find("{"), bare.rfind("}")
        if not 0 <= first < last:
            raise
        found = json.loads(bare[first : last + 1], parse_constant=_no_constant)
    if not isinstance(found, dict):
        raise ValueError("response must be a JSON object")
    return found


def answers_in(found: dict) -> tuple[bool, list[tuple[str | None, list[str]]]]:
    """(labels stand at the top, answers as (blank, labels)): a list of answers, else labels at the top, else keys such
    as ``blank_2``. In lists, entries that are no objects need labels to count."""
    for key in LIST_KEYS:
        listed = []
        for entry in found[key] if isinstance(found.get(key), list) else ():
            labels = labels_in(entry)
            if isinstance(entry, dict):
                listed.append((blank_name(entry.get("blank", entry.get("blank_index"))), labels))
            elif labels:
                listed.append((None, labels))
        if listed:
            return False, listed
    for key in SINGLE_KEYS:
        if key in found:
            if labels := labels_in(found[key]):
                return True, [(None, labels)]
            break
    numbered = [(m, labels_in(v)) for k, v in found.items() if (m := BLANK_KEY.fullmatch(k.lower()))]
    return False, [(str(int(m[1])), labels) for m, labels in numbered if labels]


def read_response(text: Column) -> Column:
    """STRUCT READ of a response. Without a JSON object there is a parse_error and no answer."""

    @F.arrow_udf(READ)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("blank", pa.string()), ("labels", pa.list_(pa.string()))]))
        for batch in batches:
            errors, parsed, tops, found = [], [], [], []
            for x in batch.to_pylist():
                error = whole = None
                top, answers = False, []
                try:
                    record = parse_response(x or "")
                    top, answers = answers_in(record)
                    whole = json.dumps(record, ensure_ascii=False, sort_keys=True)
                except (ValueError, RecursionError) as problem:
                    error = str(problem) or "nested too deep"
                errors.append(error)
                parsed.append(whole)
                tops.append(top)
                found.append([{"blank": b, "labels": n} for b, n in answers])
            columns = [pa.array(errors, pa.string()), pa.array(parsed, pa.string()), pa.array(tops, pa.bool_()), pa.array(found, kind)]
            yield pa.StructArray.from_arrays(columns, ["parse_error", "parsed_answer", "at_top", "answers"])

    return read(text)


def predicted_answers(read: Column, expected: Column) -> Column:
    """Answers of a response that was read; labels at the top belong to the only blank asked for."""
    only = F.when(F.size(expected) == 1, F.try_element_at(expected, F.lit(1))["blank"])
    return F.when(read["at_top"], F.transform(read["answers"], lambda a: _answer(only, a["labels"]))).otherwise(read["answers"])


# --- answers expected, and grading


def _letters(text: Column) -> Column:
    return F.regexp_extract_all(F.upper(text), F.lit(r"(?U)\b[A-Z]\b"), 0)


def _answer(blank: Column, found: Column) -> Column:
    return F.struct(blank.cast("string").alias("blank"), found.cast("array<string>").alias("labels"))


def expected_answers(groups: Column) -> Column:
    """Answers that typed answer groups ask for; null groups are passed over."""
    kept = F.filter(F.coalesce(groups, F.array().cast("array<struct<blank:int,choices:array<struct<label:string,text:string>>,correct_labels:array<string>>>")), lambda g: g.isNotNull())
    return F.transform(kept, lambda g: _answer(g["blank"], F.array_sort(F.array_distinct(F.flatten(F.transform(F.coalesce(g["correct_labels"], V.texts()), lambda x: F.coalesce(_letters(x), V.texts())))))))


def grade(expected: Column, predicted: Column) -> Column:
    """STRUCT<correct, missing_blanks>: expected answers in order take the first free prediction for their blank.

    One expected and one free prediction match whatever their blanks. A wrong label set, an expected answer
    without prediction and a prediction left over make the response wrong; nothing expected and nothing
    predicted is correct.
    """
    none = "\u0001"
    start = F.struct(predicted.cast(ANSWERS).alias("free"), F.lit(True).alias("right"), V.texts().alias("missing"))

    def step(state: Column, want: Column) -> Column:
        free = state["free"]
        same = F.array_position(F.transform(free, lambda p: F.coalesce(p["blank"], F.lit(none))), F.coalesce(want["blank"], F.lit(none))).cast("int")
        at = F.when(same > 0, same).when((F.size(expected) == 1) & (F.size(free) == 1), 1).otherwise(0)
        hit = F.try_element_at(free, F.greatest(at, F.lit(1)))
        left = F.concat(F.slice(free, 1, F.greatest(at - 1, F.lit(0))), F.slice(free, at + 1, F.size(free)))
        right = (at > 0) & F.coalesce(hit["labels"] == want["labels"], F.lit(False))
        lost = F.concat(state["missing"], F.when(at == 0, F.array(want["blank"])).otherwise(V.texts()))
        return F.struct(F.when(at > 0, left).otherwise(free).alias("free"), (state["right"] & right).alias("right"), lost.alias("missing"))

    done = F.aggregate(expected, start, step)
    return F.struct((done["right"] & (F.size(done["free"]) == 0)).alias("correct"), done["missing"].alias("missing_blanks"))


def response_text(generation: Column, response: Column, answer: Column) -> Column:
    """The first of the three that is set; empty text for none."""
    return F.coalesce(generation, response, answer, F.lit(""))


def record_response(record: Column) -> Column:
    """The same for a record (VARIANT): the first of the three keys that is there, with any value; objects as JSON."""
    shown = [F.when(V.key(record, k).isNotNull(), F.coalesce(V.text(V.key(record, k)), F.lit("None"))) for k in ("generation", "response", "answer")]
    return F.coalesce(*shown, F.lit(""))


def item_key(ident: Column, ord_: Column) -> Column:
    """Identifier of an item: its own if not null or empty, else item-<ord>."""
    return F.coalesce(F.nullif(ident, F.lit("")), F.concat(F.lit("item-"), ord_.cast("string")))


def grade_rows(joined: DataFrame) -> DataFrame:
    """Rows of (…, answer_groups, read) with parse_error, parsed_answer, expected, predicted, correct, missing_blanks.

    A response without a JSON object is wrong and has a parse_error.
    """
    asked = joined.withColumn("expected", expected_answers(F.col("answer_groups")))
    found = asked.withColumn("predicted", predicted_answers(F.col("read"), F.col("expected")))
    graded = found.withColumn("_g", grade(F.col("expected"), F.col("predicted")))
    broken = F.col("read.parse_error").isNotNull()
    return graded.withColumns({
        "parse_error": F.col("read.parse_error"),
        "parsed_answer": F.col("read.parsed_answer"),
        "correct": ~broken & F.col("_g.correct"),
        "missing_blanks": F.when(~broken, F.col("_g.missing_blanks")),
    }).drop("read", "_g")


def read_rows(responses: DataFrame) -> DataFrame:
    """Responses with raw_response (made of the typed texts where it is not there; absent keys are nulls in them) and read."""
    sent = responses.filter(F.col("item_id").isNotNull()).withColumn("raw_response", F.col("raw_response") if "raw_response" in responses.columns else response_text(F.col("generation"), F.col("response"), F.col("answer")))
    return sent.drop("generation", "response", "answer").withColumn("read", read_response(F.col("raw_response")))


def attempts(items: DataFrame, responses: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(item_ord, resp_id, model, raw_response, …graded): each response with each item of its id.

    Responses are read where they are stored; then a shuffled inner join on the id. Items with the same id all get the
    response; responses for unknown items are dropped. A hot item id spreads over tasks by a salt on the
    response side, the few item rows of that id being repeated once per salt.
    """
    own = items.select("item_ord", "answer_groups", item_key(F.col("id"), F.col("item_ord")).alias("item_id"))
    hot = hot_keys(responses.select("item_id"), "item_id", hot_rows)
    salted = flag_hot(read_rows(responses).select("item_id", "resp_id", "model", "raw_response", "read"), "item_id", hot).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("resp_id"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    spread = flag_hot(own, "item_id", hot).withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    joined = salted.drop("_hot").join(spread.drop("_hot"), ["item_id", "_salt"]).drop("_salt")
    return grade_rows(joined).select("item_ord", "resp_id", "model", "raw_response", "parsed_answer", "parse_error", "correct", "expected", "predicted", "missing_blanks")


def item_accuracy(items: DataFrame, graded: DataFrame) -> DataFrame:
    """(item_ord, attempts, correct, solver_accuracy): share of correct attempts, four places; null without attempts."""
    counts = graded.groupBy("item_ord").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("correct").eqNullSafe(True)).alias("correct"))
    out = items.select("item_ord").join(counts, "item_ord", "left")
    return out.select("item_ord", F.coalesce("attempts", F.lit(0)).alias("attempts"), F.coalesce("correct", F.lit(0)).alias("correct"), F.round(F.try_divide("correct", "attempts"), 4).alias("solver_accuracy"))


_RESULT = ["model", "raw_response", "parsed_answer", "parse_error", "correct", "expected", "predicted", "missing_blanks"]


def _counts(graded: DataFrame) -> DataFrame:
    return graded.groupBy("item_ord").agg(F.count(F.lit(1)).alias("n_attempts"), F.round(F.avg(F.col("correct").eqNullSafe(True).cast("int")), 4).alias("solver_accuracy"))


def result_chunks(graded: DataFrame, most: int | None = MOST_IN_ARRAY) -> DataFrame:
    """(item_ord, chunk, solver_results): the attempts of each item in arrays of about ``most``, each in order of resp_id.

    An item of at most ``most`` attempts (any number, if None) has one chunk, 0. More are dealt to chunks by a hash of resp_id, so no
    task holds all attempts of a hot item and none is left out.
    """
    chunk, rows = F.lit(0), graded
    if most is not None:
        chunks = F.ceil(F.col("n_attempts") / most).cast("int")
        many = broadcast_if_small(_counts(graded).filter(F.col("n_attempts") > most).select("item_ord", chunks.alias("_chunks")))
        rows, chunk = graded.join(many, "item_ord", "left"), F.coalesce(F.pmod(F.xxhash64("resp_id"), F.col("_chunks")), F.lit(0))
    lists = rows.groupBy("item_ord", chunk.cast("int").alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("resp_id", *_RESULT))).alias("_rows"))
    return lists.select("item_ord", "chunk", F.transform("_rows", lambda r: F.struct(*[r[n].alias(n) for n in _RESULT])).alias("solver_results"))


def attach_results(items: DataFrame, graded: DataFrame, most: int | None = None) -> DataFrame:
    """``items`` with solver_results, n_attempts and solver_accuracy from graded attempts; no attempts give an empty array.

    The array holds all of an item's attempts. A caller that keeps ``graded`` or its ``result_chunks`` beside the items may
    give ``most``: an item of more attempts then has the first of its chunks in the array, and n_attempts tells how
    many there are. The accuracy counts all of them.
    """
    first = result_chunks(graded, most).filter("chunk = 0").drop("chunk")
    bare = items.drop("solver_results", "solver_accuracy", "n_attempts").join(_counts(graded), "item_ord", "left").join(first, "item_ord", "left")
    return bare.withColumns({"solver_results": F.coalesce("solver_results", F.array().cast(RESULTS)), "n_attempts": F.coalesce("n_attempts", F.lit(0))})


def unknown_responses(items: DataFrame, responses: DataFrame) -> DataFrame:
    """Responses whose item_id names no item (null ids too). Only distinct ids are compared with the items', so a hot id is one row."""
    own = items.select(item_key(F.col("id"), F.col("item_ord")).alias("item_id"))
    unknown = responses.filter(F.col("item_id").isNotNull()).select("item_id").distinct().join(own, "item_id", "left_anti")
    return responses.join(broadcast_if_small(unknown), "item_id", "left_semi").unionByName(responses.filter(F.col("item_id").isNull()))


def model_totals(graded: DataFrame) -> DataFrame:
    """(model, total, correct, accuracy): attempts per model; a null model is called None. Combined before the shuffle."""
    by = graded.groupBy(F.coalesce("model", F.lit("None")).alias("model")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("correct").eqNullSafe(True)).alias("correct"))
    return by.withColumn("accuracy", F.round(F.col("correct") / F.col("total"), 4))


def solver_summary(per_item: DataFrame) -> DataFrame:
    """One row from (attempts, correct, solver_accuracy) per item; accuracies are null without attempts."""
    return per_item.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("total_solver_attempts"),
        F.round(F.try_divide(F.sum("correct"), F.sum("attempts")), 4).alias("overall_accuracy"),
        F.round(F.avg("solver_accuracy"), 4).alias("average_item_accuracy"),
    )
