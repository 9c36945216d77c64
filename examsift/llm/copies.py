"""Duplicates hidden by formatting: one record per content, with the number of its copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examsift.operators.sizing import HOT_ROWS, groups_of_key, hot_keys, smallest_of_key
from examsift.runtime import cut_lineage

#: Stands between parts of a key; it is neither a letter nor a digit, so no part contains it.
BETWEEN = "\u0001"


def bare(text: Column) -> Column:
    """Lower case with only letters and digits kept; null is empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", "")


def item_form(stem: Column, answer_groups: Column) -> Column:
    """128-bit key of an item's content: the bare stem and the multiset of all bare choice texts.

    Choices count in any order and group. Null groups, null or empty choice lists add nothing; a null
    choice or choice text counts as an empty text.
    """
    none = F.array().cast("array<string>")
    texts = F.flatten(F.transform(answer_groups, lambda g: F.coalesce(F.transform(g["choices"], lambda c: bare(c["text"])), none)))
    texts = F.sort_array(F.coalesce(texts, none))
    return F.unhex(F.md5(F.concat(bare(stem), F.lit(BETWEEN), F.size(texts).cast("string"), F.lit(BETWEEN), F.array_join(texts, BETWEEN)).cast("binary")))


def _keyed(items: DataFrame) -> DataFrame:
    """(item_ord, _form), written once."""
    return cut_lineage(items.select("item_ord", item_form(F.col("stem"), F.col("answer_groups")).alias("_form")))


def hidden_copies(items: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(keep_ord, item_ord) for each item that is a copy of an earlier one; repeated rows of one item_ord give none.

    Rows whose item_ord is null count as copies but are never kept and give no row.
    """
    done = smallest_of_key(_keyed(items), "_form", "item_ord", hot_rows)
    return done.filter(F.col("item_ord") != F.col("keep")).select(F.col("keep").alias("keep_ord"), "item_ord")


def collapsed_items(items: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(item_ord, n_copies): one row per content, named by its smallest item_ord, with the number of its rows.

    Contents whose item_ords are all null give no row.
    """
    keyed = _keyed(items)
    groups = groups_of_key(keyed, "_form", "item_ord", hot_keys(keyed, "_form", hot_rows))
    return groups.filter("keep is not null").select(F.col("keep").alias("item_ord"), "n_copies")
