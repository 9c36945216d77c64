"""Decisions that need a checked size: broadcasting, hot keys, copies of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and bytes (of the rows' JSON) up to which a side is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 64 << 20
#: Rows a key needs at least to be hot: fewer fit any task.
HOT_ROWS = 20_000
#: Hot keys there can be at most: in larger tables a hot key needs more rows than one in so many.
MOST_HOT = 50_000
#: Hot keys up to which they stand in the plan as literals; more are joined.
AS_LITERALS = 200
#: Parts into which the rows of a hot key are split.
SALTS = 64


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and ``most_bytes`` bytes, else unchanged (a shuffled join)."""
    size = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("b")).first()
    return F.broadcast(df) if size.n <= rows and (size.b or 0) <= most_bytes else df


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list:
    """Keys with more than ``hot_rows`` rows, or in very large tables more than one row in MOST_HOT.

    Exact: counts are combined before the shuffle, so a hot key costs one row per map task. The list
    has at most MOST_HOT entries, whatever the size of ``df``. The null key is never listed.
    """
    rows = df.count()
    if rows <= hot_rows:
        return []
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    return [r[0] for r in counts.filter(F.col("count") > max(hot_rows, rows // MOST_HOT)).select(key).collect()]


def flag_hot(df: DataFrame, key: str, hot: list, out: str = "_hot") -> DataFrame:
    """``df`` with ``out``: whether its key is one of ``hot`` (as many as ``hot_keys`` gives)."""
    if len(hot) <= AS_LITERALS:
        return df.withColumn(out, F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False))
    named = df.sparkSession.createDataFrame([(k, True) for k in hot], f"{key} {df.schema[key].dataType.simpleString()}, {out} boolean")
    return df.join(F.broadcast(named), key, "left").withColumn(out, F.coalesce(out, F.lit(False)))  # at most MOST_HOT keys


def groups_of_key(df: DataFrame, key: str, ident: str, hot: list) -> DataFrame:
    """(``key``, keep, n_copies): smallest ``ident`` and number of rows of each key that is not null.

    Rows of ``hot`` keys are salted and aggregated on two levels, all others on one.
    """
    flagged = flag_hot(df.filter(F.col(key).isNotNull()), key, hot)
    parts: list[Column] = [F.min(ident).alias("keep"), F.count(F.lit(1)).alias("n_copies")]
    out = flagged.filter(~F.col("_hot")).groupBy(key).agg(*parts)
    if hot:
        salted = flagged.filter("_hot").groupBy(key, F.pmod(F.xxhash64(ident), F.lit(SALTS)).alias("_salt")).agg(*parts)
        out = out.unionByName(salted.groupBy(key).agg(F.min("keep").alias("keep"), F.sum("n_copies").alias("n_copies")))
    return out


def smallest_of_key(df: DataFrame, key: str, ident: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``keep`` (the smallest ``ident`` of the rows with the same key) and ``n_copies`` (their number).

    Keys are aggregated (``groups_of_key``) and only keys of several rows are joined back: hot ones by a
    broadcast of at most MOST_HOT rows, so their rows are never shuffled; the rest by one shuffle by key in
    which no key has more rows than a task bears. Rows with a null key are their own only copy.
    """
    hot = hot_keys(df, key, hot_rows)
    several = flag_hot(groups_of_key(df, key, ident, hot).filter("n_copies > 1"), key, hot)
    flagged = flag_hot(df, key, hot)
    out = flagged.filter(~F.col("_hot")).drop("_hot").join(several.filter(~F.col("_hot")).drop("_hot"), key, "left")
    if hot:
        out = out.unionByName(flagged.filter("_hot").drop("_hot").join(F.broadcast(several.filter("_hot").drop("_hot")), key))
    alone = F.col("n_copies").isNull()
    return out.withColumns({"keep": F.when(alone, F.col(ident)).otherwise(F.col("keep")), "n_copies": F.coalesce("n_copies", F.lit(1).cast("long"))})
