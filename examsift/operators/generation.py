"""From model output to items: salvage, explode, defaults, prompts; and generation through a provider."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.functions import variants as V
from examsift.functions.constants import ANSWER_KEYS, GROUP_ANSWER_KEYS
from examsift.operators.answers import salvage, unfence


def seed_name(seed_id: Column, ord_: Column) -> Column:
    """Identifier of a seed for generation: its own if not null or empty, else seed-<ord>."""
    return F.coalesce(F.nullif(seed_id, F.lit("")), F.concat(F.lit("seed-"), ord_.cast("string")))


def listed_items(parsed: Column) -> Column:
    """ARRAY<VARIANT> of a generation: a bare list, or the list under ``items``; NULL for any other shape."""
    return F.coalesce(V.elements(parsed), V.elements(V.key(parsed, "items")))


def parse_generations(raw: DataFrame, text: str = "generation") -> DataFrame:
    """``raw`` with ``items`` and ``error``: a generation whose list holds anything but objects fails as a whole."""
    # a whole list counts, and also an object or list inside other text
    bare = unfence(F.col(text))
    parsed = F.coalesce(V.parse(bare), salvage(F.col(text)))
    out = raw.withColumn("_p", parsed).withColumn("_i", listed_items(F.col("_p")))
    error = (
        F.when(F.col("_p").isNull(), "generation holds no JSON")
        .when(F.col("_i").isNull(), "generation must be a JSON object with an 'items' list")
        .when(~F.forall("_i", V.is_object), "each generated item must be a JSON object")
    )
    return out.withColumn("error", error).withColumn("items", F.when(F.col("error").isNull(), F.col("_i"))).drop("_p", "_i")


def failed_generations(parsed: DataFrame) -> DataFrame:
    """Rows that gave no items, with the error."""
    return parsed.filter(F.col("error").isNotNull()).select("seed_id", "question_type", "model_name", "error", "generation")


def explode_items(parsed: DataFrame, prompt_version: str, ord_: str = "gen_id") -> DataFrame:
    """(``ord_``, pos, item): one row per generated item as MAP<STRING, VARIANT>, unknown keys included.

    Absent keys get defaults: id synthetic-<seed>-<nnn>, source_seed_id, generation_model, prompt_version.
    A key that is there keeps its value, null too.
    """
    seed = seed_name(F.col("seed_id"), F.col(ord_))
    rows = parsed.filter(F.col("error").isNull()).select(ord_, seed.alias("_seed"), "model_name", F.posexplode("items").alias("pos", "_item"))
    number = F.lpad((F.col("pos") + 1).cast("string"), 3, "0")
    defaults = {
        "id": F.concat(F.lit("synthetic-"), F.col("_seed"), F.lit("-"), F.when(F.col("pos") < 999, number).otherwise((F.col("pos") + 1).cast("string"))),
        "source_seed_id": F.col("_seed"),
        "generation_model": F.col("model_name"),
        "prompt_version": F.lit(prompt_version),
    }
    own = V.fields(F.col("_item"))
    as_variant = [F.struct(F.lit(k).alias("key"), F.parse_json(F.to_json(F.array(v))).alias("value")) for k, v in defaults.items()]
    added = F.transform(F.filter(F.array(*as_variant), lambda e: ~F.map_contains_key(own, e["key"])), lambda e: F.struct(e["key"].alias("key"), F.try_variant_get(e["value"], "$[0]", "variant").alias("value")))
    return rows.select(ord_, "pos", F.map_from_entries(F.concat(F.map_entries(own), added)).alias("item"))


def redacted(record: Column) -> Column:
    """MAP<STRING, VARIANT> of a record without what gives its answer away; groups that are no objects are dropped."""
    shown = F.map_filter(V.fields(record), lambda k, _: ~k.isin([*ANSWER_KEYS, "answer_groups"]))
    groups = F.filter(V.list_of(V.key(record, "answer_groups")), V.is_object)
    bare = F.transform(groups, lambda g: F.map_filter(V.fields(g), lambda k, _: ~k.isin(GROUP_ANSWER_KEYS)))
    return F.map_concat(shown, F.create_map(F.lit("answer_groups"), F.parse_json(F.to_json(bare))))


def render(template: str, **values: Column) -> Column:
    """The template with each ``{{NAME}}`` replaced in turn (so a value may hold a later placeholder)."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    return out


def pipeline_name(model: Column) -> Column:
    """A model's name with anything but letters, digits, _ . and - as a dash."""
    return F.regexp_replace(model, "[^A-Za-z0-9_.-]+", "-")


def slug(model: str) -> str:
    """The same for a name on the driver."""
    return re.sub("[^A-Za-z0-9_.-]+", "-", model)


def model_list(asked: list[str] | None, environment: dict[str, str], fallback: str = "gpt-4o") -> list[str]:
    """Models to ask: those given (parts separated by commas), else OPENAI_SOLVER_MODELS, else OPENAI_MODEL or ``fallback``."""
    def parts(texts: list[str]) -> list[str]:
        return [m.strip() for t in texts for m in t.split(",") if m.strip()]

    return parts(asked or []) or parts([environment.get("OPENAI_SOLVER_MODELS", "")]) or [environment.get("OPENAI_MODEL") or fallback]


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


# --- providers

#: A provider turns a batch of (instruction, system_prompt) and parameters into texts.
Provider = Callable[[list[str], list[str], dict], list[str]]


def _one_text(given: Any) -> str | None:
    """The text of a generation: of a list its first element (empty text for an empty list)."""
    if isinstance(given, list):
        given = given[0] if given else ""
    return None if given is None else str(given)


def generate(requests: DataFrame, provider: Provider, parameters: dict, keys: list[str]) -> DataFrame:
    """``keys`` and ``generation`` for requests with instruction and system_prompt; batches go to the provider on executors.

    A batch whose call fails gives null texts, and the run goes on. Write the result before using it
    twice: a provider need not answer alike.
    """
    kind = requests.select(*keys).schema.add("generation", "string")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                texts = [_one_text(t) for t in provider(batch["instruction"].tolist(), batch["system_prompt"].tolist(), parameters)]
            except Exception:  # one failed call must not lose the others
                texts = [None] * len(batch)
            yield batch[keys].assign(generation=texts)

    return requests.mapInPandas(ask, kind)


def request_hash(parameters: dict) -> Column:
    """Hash of a request (instruction and system_prompt) and of the parameters it is made with."""
    made_with = json.dumps(parameters, sort_keys=True)
    return F.sha2(F.concat_ws("\u0001", F.lit(made_with), F.coalesce("system_prompt", F.lit("")), F.coalesce("instruction", F.lit(""))), 256)


def generate_cached(requests: DataFrame, provider: Provider, parameters: dict, keys: list[str], cache: str) -> DataFrame:
    """``generate`` with a cache: a folder of Parquet files (request_hash, generation).

    Only requests without an answer there are sent, each once however often it occurs; their answers (not failed
    calls) are appended, then all requests are answered from the folder.
    """
    spark = requests.sparkSession
    hashed = requests.withColumn("request_hash", request_hash(parameters))

    def known() -> DataFrame:
        try:
            rows = spark.read.parquet(cache)
        except AnalysisException:  # nothing kept so far
            rows = spark.createDataFrame([], "request_hash string, generation string")
        return rows.groupBy("request_hash").agg(F.min("generation").alias("generation"))

    new = hashed.join(known(), "request_hash", "left_anti").dropDuplicates(["request_hash"])
    made = generate(new, provider, parameters, ["request_hash"])
    made.filter("generation is not null").select("request_hash", "generation").write.mode("append").parquet(cache)
    return hashed.join(known(), "request_hash", "left").select(*keys, "generation")
