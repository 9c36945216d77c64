"""Verdicts on items: seeds for the judge, verdict salvage, the accept gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.functions import variants as V
from examsift.operators.answers import item_key, salvage
from examsift.operators.sizing import broadcast_if_small


def seed_map(seeds: DataFrame, ord_: str = "ord") -> DataFrame:
    """(key, seed…): one seed per key (seed_id, else question_id if there is such a column, else seed-<ord>); of seeds with
    the same key the last one."""
    own = [F.nullif(n, F.lit("")) for n in ("seed_id", "question_id") if n in seeds.columns]
    key = F.coalesce(*own, F.concat(F.lit("seed-"), F.col(ord_).cast("string")))
    names = [c for c in seeds.columns if c != ord_]
    last = seeds.withColumn("key", key).groupBy("key").agg(F.max_by(F.struct(*names), ord_).alias("seed"))
    return last.select("key", *[F.col(f"seed.{n}").alias(n) for n in names])


def with_seed(items: DataFrame, seeds: DataFrame) -> DataFrame:
    """``items`` with ``seed`` (STRUCT, null where the item's source_seed_id names none)."""
    named = broadcast_if_small(seeds.select(F.col("key").alias("_key"), F.struct(*[c for c in seeds.columns if c != "key"]).alias("seed")))
    return items.drop("seed").join(named, F.col("source_seed_id") == F.col("_key"), "left").drop("_key")


def verdicts(outputs: DataFrame, text: str = "generation") -> DataFrame:
    """``outputs`` with ``judge``: the parsed verdict (VARIANT), or for broken output a verdict that is not valid, has
    score 1, names the failure and keeps the output as reason."""
    lost = F.parse_json(F.to_json(F.struct(F.lit(False).alias("valid"), F.lit(1).alias("score"), F.array(F.lit("judge output parse failure")).alias("issues"), F.coalesce(text, F.lit("")).alias("reason"))))
    return outputs.withColumn("judge", F.coalesce(salvage(F.col(text)), lost))


def review(outputs: DataFrame, items: DataFrame) -> DataFrame:
    """Each judge output with its item, by item_id; items without id are known as item-<ord> on both sides.

    Of items with the same id the last one is reviewed; an output for an unknown item stays, without item fields.
    """
    names = [c for c in items.columns if c != "judge"]
    own = items.withColumn("item_id", item_key(F.col("id"), F.col("item_ord"))).groupBy("item_id").agg(F.max_by(F.struct(*names), "item_ord").alias("item"))
    return verdicts(outputs).join(own, "item_id", "left")


def accepts(judge: Column, least: int = 4) -> Column:
    """Valid, and the whole part of the score is at least ``least``; a score that is no number fails."""
    score = F.coalesce(V.number(V.key(judge, "score")), F.expr("try_cast(NULL AS DOUBLE)"))
    text_score = F.try_variant_get(V.key(judge, "score"), "$", "int")
    return V.is_true(V.key(judge, "valid")) & F.coalesce(F.coalesce(score.cast("int"), text_score) >= least, F.lit(False))


def typed_accepts(judge: Column, least: int = 4) -> Column:
    """The same for a typed verdict."""
    return judge["valid"].eqNullSafe(True) & F.coalesce(judge["score"] >= least, F.lit(False))
