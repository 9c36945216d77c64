"""Nested item records as flat node tables, linked by interval labels.

Every node of a record's tree gets a pre-order and a post-order number in one depth-first walk. A node
lies below another exactly if its pre-order number is greater and its post-order number smaller, so
child and parent tables are linked by interval containment, whatever the depth between them.

Shapes are taken as they come: a lone object (for texts: a lone string) where an array is expected is an
array of one; choices given as one object are one choice per label; answer_groups, solver_results and
judge given as a string of JSON stand for that JSON. Elements of other kinds keep their position and give
no node. Lines that are null, blank, broken or not an object give no node.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Children by parent type: key -> (type of the child, what counts: objects "o", strings "s", one object "1", may be a string of JSON "j").
SHAPE: dict[str, dict[str, tuple[str, str]]] = {
    "item": {"passages": ("passage", "os"), "answer_groups": ("answer_group", "oj"), "solver_results": ("solver_result", "oj"), "judge": ("judge", "1j")},
    "answer_group": {"choices": ("choice", "om"), "correct_labels": ("correct_label", "s")},
    "solver_result": {"expected": ("expected", "o"), "predicted": ("predicted", "o")},
    "judge": {"issues": ("judge_issue", "s")},
}
PARENT = {child: parent for parent, keys in SHAPE.items() for child, _ in keys.values()}


class _Walk:
    """One depth-first walk over a record."""

    def __init__(self, with_fields: bool):
        self.nodes: list[tuple[str, int, int, int, str | None]] = []
        self.pre = self.post = -1
        self.with_fields = with_fields

    def enter(self) -> int:
        self.pre += 1
        return self.pre

    def leave(self) -> int:
        self.post += 1
        return self.post

    def count(self, value: Any) -> None:
        """Number a subtree without nodes of interest; iterative, so depth does not matter."""
        stack, n = [value], 0
        while stack:
            x = stack.pop()
            n += 1
            if isinstance(x, dict):
                stack.extend(x.values())
            elif isinstance(x, list):
                stack.extend(x)
        self.pre += n
        self.post += n

    def typed(self, kind: str, pos: int, value: Any) -> None:
        pre, rules = self.enter(), SHAPE.get(kind, {})
        if isinstance(value, dict):
            for key, child in value.items():
                if key in rules:
                    self.array(*rules[key], child)
                else:
                    self.count(child)
        self.nodes.append((kind, pos, pre, self.leave(), _fields(value, rules) if self.with_fields else None))

    def array(self, kind: str, accept: str, value: Any) -> None:
        if "j" in accept and isinstance(value, str):
            try:
                value = json.loads(value)
            except (ValueError, RecursionError):
                pass
        if "1" in accept:
            return self.typed(kind, 0, value) if isinstance(value, dict) else self.count(value)
        if "m" in accept and isinstance(value, dict) and not {"label", "text"} <= value.keys():
            value = [{"label": k, "text": v} for k, v in value.items()]
        if isinstance(value, dict) or ("s" in accept and isinstance(value, str)):
            value = [value]
        if not isinstance(value, list):
            return self.count(value)
        self.enter()
        for pos, x in enumerate(value):
            if (isinstance(x, dict) and ("o" in accept)) or (isinstance(x, str) and "s" in accept):
                self.typed(kind, pos, x)
            else:
                self.count(x)
        self.leave()
        return None


def _fields(value: Any, rules: dict) -> str:
    own = {k: v for k, v in value.items() if k not in rules} if isinstance(value, dict) else {"text": value}
    return json.dumps(own, ensure_ascii=False)


def parse_nodes(line: str | None, with_fields: bool = True) -> list[tuple[str, int, int, int, str | None]]:
    """(type, pos, pre, post, fields as JSON) of each node of interest of a line, children before parents."""
    try:
        record = json.loads(line or "")
    except (ValueError, RecursionError):
        return []
    if not isinstance(record, dict):
        return []
    walk = _Walk(with_fields)
    walk.typed("item", 0, record)
    return walk.nodes


def node_table(lines: DataFrame, key: str = "line_no", line: str = "line", with_fields: bool = True) -> DataFrame:
    """(``key``, occurrence, node, pos, pre, post, fields): all nodes of all lines.

    ``occurrence`` tells rows that share a key apart, so a repeated row keeps its own tree. ``fields`` holds the
    node's own fields (not its typed children) as JSON, or null without ``with_fields``. Narrow: no shuffle.
    """
    kind = f"`{key}` bigint, occurrence bigint, node string, pos int, pre int, post int, fields string"
    names = [key, "occurrence", "node", "pos", "pre", "post", "fields"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, marks, texts = (batch.column(i).to_pylist() for i in range(3))
            rows: list[tuple] = []
            for k, m, t in zip(keys, marks, texts):
                rows += [(k, m, *n) for n in parse_nodes(t, with_fields)]
            types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            columns = zip(*rows) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    rows = lines.select(F.col(f"`{key}`").cast("bigint").alias(key), F.monotonically_increasing_id().alias("occurrence"), F.col(f"`{line}`").alias("line"))
    return rows.mapInArrow(parse, kind)


def _schema_of(kind: str) -> str:
    return {
        "item": "id string, question_type string, subtype string, difficulty string, stem string, stimulus string, passage string, explanation string",
        "passage": "label string, text string",
        "answer_group": "blank string",
        "choice": "label string, text string",
        "correct_label": "text string",
        "solver_result": "model string, raw_response string, parse_error string, correct boolean",
        "expected": "blank string, labels string",
        "predicted": "blank string, labels string",
        "judge": "valid boolean, score string, reason string",
        "judge_issue": "text string",
    }[kind]


def typed_table(nodes: DataFrame, kind: str, key: str = "line_no") -> DataFrame:
    """The node table of one type: ``key``, occurrence, pos, pre, post and the type's own fields as columns."""
    rows = nodes.filter(F.col("node") == kind)
    return rows.select(key, "occurrence", "pos", "pre", "post", F.from_json("fields", _schema_of(kind)).alias("_f")).select(key, "occurrence", "pos", "pre", "post", "_f.*")


def link_children(nodes: DataFrame, key: str = "line_no") -> DataFrame:
    """Each node but the root with ``parent_pos``: the position of the node of its parent type that contains it.

    Nodes of one parent type never contain each other, so among those with a smaller pre-order number
    only the last can contain the child: one pass over the record in pre-order finds it, and the
    post-order numbers confirm containment. Children of the record itself get -1. One shuffle of narrow
    rows by record.
    """
    order = W.partitionBy("occurrence").orderBy("pre").rowsBetween(W.unboundedPreceding, W.currentRow)
    inner = sorted(set(PARENT.values()) - {"item"})
    found = nodes.withColumns({f"_p_{p}": F.last(F.when(F.col("node") == p, F.struct("pos", "post")), ignorenulls=True).over(order) for p in inner})

    def parent_pos(kind: str) -> Column:
        if PARENT[kind] == "item":
            return F.lit(-1)
        above = F.col(f"_p_{PARENT[kind]}")
        return F.when(F.col("post") < above["post"], above["pos"])

    pick = F.coalesce(*[F.when(F.col("node") == kind, parent_pos(kind)) for kind in PARENT])
    return found.withColumn("parent_pos", pick).filter(F.col("node") != "item").drop(*[f"_p_{p}" for p in inner])


def typed_children(lines: DataFrame, kind: str, key: str = "line_no", line: str = "line") -> DataFrame:
    """(``key``, parent_pos, pos, fields of the type…): the flat table of one type of child with its parent's position.

    Lines are parsed once; of other nodes only the labels are moved.
    """
    nodes = node_table(lines, key, line)
    linked = link_children(nodes.withColumn("fields", F.when(F.col("node") == kind, F.col("fields"))), key).filter(F.col("node") == kind)
    return linked.select(key, "parent_pos", "pos", F.from_json("fields", _schema_of(kind)).alias("_f")).select(key, "parent_pos", "pos", "_f.*")


def child_rows(lines: DataFrame, key: str = "line_no", line: str = "line") -> DataFrame:
    """(``key``, child, parent_pos, pos): one row per child of each line that is an object."""
    linked = link_children(node_table(lines, key, line, with_fields=False), key)
    return linked.select(key, F.col("node").alias("child"), "parent_pos", "pos")
