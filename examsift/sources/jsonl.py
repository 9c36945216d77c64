"""Reading and writing JSON lines."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from examsift.functions import variants as V
from examsift.operators.sizing import broadcast_if_small


SPLIT = ["file_idx", "_file", "_start"]


def _numbered(rows: DataFrame, out: str, per: list[str]) -> DataFrame:
    """``rows`` of file splits (SPLIT) with ``out``: the 1-based place in the order of the files, counted anew for each ``per``.

    A split's rows stand one behind the other in one task, so their places in it are differences of
    increasing ids; the rows before a split come from counts, one per split. No line is moved.
    """
    marked = rows.withColumn("_at", F.monotonically_increasing_id())
    splits = marked.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = W.partitionBy(*per).orderBy(*SPLIT).rowsBetween(W.unboundedPreceding, -1)  # one row per split
    placed = splits.select(*SPLIT, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return marked.join(broadcast_if_small(placed), SPLIT).withColumn(out, F.col("_at") + F.col("_shift")).drop("_at", "_shift")


def _split_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(SPLIT…, line_no, line) of files."""
    out = None
    for n, path in enumerate([paths] if isinstance(paths, str) else paths):
        own = spark.read.text(path).select(F.lit(n).alias("file_idx"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.col("value").alias("line"))
        out = own if out is None else out.unionByName(own)
    if out is None:
        return spark.createDataFrame([], "file_idx int, _file string, _start bigint, line string, line_no bigint")
    return _numbered(out, "line_no", ["file_idx"])


def read_lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(file_idx, line_no, line): the lines of files, the physical line number starting at 1.

    Files keep the order given; blank lines count. An empty list of paths gives no line.
    """
    return _split_lines(spark, paths).select("file_idx", "line_no", "line")


def read_records(spark: SparkSession, paths: list[str] | str, ord_: str) -> DataFrame:
    """(file_idx, line_no, line, record, ``ord_``): records of files, numbered from 1 over all files; a broken line is an error."""
    lines = parse_lines(_split_lines(spark, paths), strict=True)
    return _numbered(lines, ord_, []).drop("_file", "_start", "line_error")


def parse_lines(lines: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """``lines`` that are not blank, with ``record`` (VARIANT) and ``line_error``.

    The error tells broken lines and values that are no object apart; the record is null then. With
    ``strict`` reading such a line fails, naming file and line.
    """
    kept = lines.filter(F.regexp_replace(F.coalesce(line, F.lit("")), r"(?U)\s+", "") != "").withColumn("_v", V.parse(F.col(line)))
    problem = F.when(F.col("_v").isNull(), "invalid JSON").when(~V.is_object(F.col("_v")), "row must be a JSON object")
    out = kept.withColumns({"record": F.when(problem.isNull(), F.col("_v")), "line_error": problem}).drop("_v")
    if strict:
        place = F.concat_ws(":", *[F.col(c).cast("string") for c in ("file_idx", "line_no") if c in lines.columns])
        stop = F.raise_error(F.concat(place, F.lit(": "), F.col("line_error"))).cast("boolean")
        out = out.filter(F.when(F.col("line_error").isNull(), True).otherwise(stop))  # a filter is never pruned
    return out


def response_errors(record: Column) -> Column:
    """What a response record lacks: item_id, model, or all of generation, response and answer; null if nothing."""
    has = {k: V.key(record, k).isNotNull() for k in ("item_id", "model", "generation", "response", "answer")}
    return F.when(~has["item_id"], "response row missing item_id").when(~has["model"], "response row missing model").when(
        ~(has["generation"] | has["response"] | has["answer"]), "response row missing generation/response/answer"
    )


def answer_key(spark: SparkSession, text: str) -> DataFrame:
    """(section, question, label) of a JSON answer key {section: {question: label}}."""
    whole = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", "map<string,map<string,string>>").alias("m"))
    return whole.select(F.explode("m").alias("section", "q")).select("section", F.explode("q").alias("question", "label"))


def read_text(path: str) -> str:
    """A prompt template or other small text file, whole."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def to_line(columns: list[str]) -> Column:
    """One JSON object per row with sorted keys; nulls are kept, non-ASCII text stays."""
    return F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def write_lines(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Write rows as JSON lines, in ``order`` if given (a range-partitioned sort), replacing what is there."""
    ordered = df.orderBy(*order) if order else df
    ordered.select(to_line(df.columns).alias("value")).write.mode("overwrite").text(path)


def write_summary(one_row: DataFrame, path: str, **more: DataFrame) -> dict:
    """Write a one-row summary as indented JSON with sorted keys; each further (name, value) table becomes a map in it."""
    row = one_row.first()
    out = row.asDict(recursive=True) if row else {}
    for name, pairs in more.items():
        out[name] = {str(r[0]): r[1].asDict(True) if hasattr(r[1], "asDict") else r[1] for r in pairs.collect()}  # a row per reason or model
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(out, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n")
    return out
