"""Mixing sources to target weights, measured in tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examsift.llm.tokenizing import token_count
from examsift.operators.sizing import broadcast_if_small
from examsift.runtime import cut_lineage

#: The mixture has the tokens of all documents divided by this.
PART = 4


def document_sizes(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of each document, written once so that texts are encoded once."""
    return cut_lineage(documents.select("doc_id", "source", token_count(F.col("text"), vocabulary).alias("n_tokens")))


def source_rates(sizes: DataFrame, targets: DataFrame, part: int = PART) -> DataFrame:
    """Per row of ``targets``: tokens of the source, tokens wanted, and ``rate`` (copies per document).

    The rate is wanted / tokens, at most max_repeats, and 0 for a source without tokens. ``met`` is
    false where max_repeats passes hold fewer tokens than wanted. Null sources in documents count in
    the total but in no target; null shares and repeats in targets are 0. One aggregation over
    (source, tokens), combined before its shuffle, so a source with most rows is no burden.
    """
    per_source = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    total = per_source.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    share, most = F.coalesce("target_share", F.lit(0.0)), F.coalesce("max_repeats", F.lit(0))
    joined = targets.select("source", share.alias("target_share"), most.alias("max_repeats")).join(per_source, "source", "left")
    tokens = F.coalesce("tokens", F.lit(0))
    wanted = F.col("target_share") * F.lit(total / part)
    rates = joined.select("source", "target_share", "max_repeats", tokens.alias("tokens"), wanted.alias("wanted"))
    rate = F.when(F.col("tokens") > 0, F.least(F.col("wanted") / F.col("tokens"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    return rates.withColumns({"rate": rate, "met": ~(F.col("max_repeats") * F.col("tokens") < F.col("wanted"))})


def unmet_sources(documents: DataFrame, targets: DataFrame, vocabulary: str | None = None, part: int = PART) -> DataFrame:
    """Sources that cannot fill their share within their repeats."""
    return source_rates(document_sizes(documents, vocabulary), targets, part).filter(~F.col("met")).select("source")


def emitted(sizes: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """``sizes`` of sources with a target, with the rate and ``copies``: floor(rate), and one more with the probability left."""
    draw = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source")), F.lit(1 << 52)) / F.lit(float(1 << 52)))
    whole = F.floor("rate")
    copies = (whole + (draw < F.col("rate") - whole).cast("long")).cast("int")
    return sizes.join(broadcast_if_small(rates.select("source", "rate")), "source").withColumn("copies", copies)


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 7, vocabulary: str | None = None, part: int = PART) -> DataFrame:
    """(doc_id, source, copy, n_tokens): each document floor(rate) times and once more with the probability left.

    The draw is a hash of seed, doc_id and source: the same on every run and whatever the partitions.
    Documents of sources without a target, and of a null source, are left out.
    """
    sizes = document_sizes(documents, vocabulary)
    out = emitted(sizes, source_rates(sizes, targets, part), seed).filter("copies > 0")
    return out.select("doc_id", "source", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "n_tokens")


def shares_reached(documents: DataFrame, targets: DataFrame, seed: int = 7, vocabulary: str | None = None, part: int = PART) -> DataFrame:
    """Per target: tokens, rate, documents and tokens emitted, actual_share of the mixture, met."""
    sizes = document_sizes(documents, vocabulary)
    rates = source_rates(sizes, targets, part)
    sent = emitted(sizes, rates, seed).groupBy("source").agg(F.sum("copies").alias("rows_out"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens_out"))
    out = rates.join(sent, "source", "left").withColumns({"rows_out": F.coalesce("rows_out", F.lit(0)), "tokens_out": F.coalesce("tokens_out", F.lit(0))})
    total = sent.agg(F.sum("tokens_out")).first()[0] or 0
    return out.withColumn("actual_share", F.coalesce(F.try_divide("tokens_out", F.lit(total)), F.lit(0.0))).drop("wanted")
