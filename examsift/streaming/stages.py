"""Stateless stages on streams: parse, validate, grade and gate records as they arrive.

Each takes and gives a DataFrame that may stream. The order by hardness and the accuracy target need all
items and stay batch work: run them in ``foreachBatch`` over what the stream has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from examsift.operators import answers, rules
from examsift.sources.jsonl import parse_lines


def read_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(line): lines of text files as they appear in a folder."""
    return spark.readStream.text(folder).select(F.col("value").alias("line"))


def validate_stream(lines: DataFrame) -> DataFrame:
    """(line, line_error, rule_errors) of each line that is not blank."""
    return rules.with_errors(parse_lines(lines)).drop("record")


def grade_stream(responses: DataFrame, items: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Graded responses with the columns ``more`` of the response: a stream of responses joined with a table of items."""
    own = items.select("item_ord", "answer_groups", answers.item_key(F.col("id"), F.col("item_ord")).alias("item_id"))
    return answers.grade_rows(answers.read_rows(responses).join(own, "item_id")).select("item_ord", "resp_id", "model", "parse_error", "correct", *more)


def accuracy_by_window(graded: DataFrame, event_time: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(window, model, total, correct): attempts per event-time window and model, with a watermark for late rows."""
    return graded.withWatermark(event_time, late).groupBy(F.window(event_time, window), "model").agg(F.count(F.lit(1)).alias("total"), F.count_if("correct").alias("correct"))


def write_stream(df: DataFrame, path: str, checkpoint: str):
    """Append a stream to Parquet, exactly once by its checkpoint, with what is there now; returns the query."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
