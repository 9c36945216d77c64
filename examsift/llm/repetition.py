"""Repetition inside a single document, by line-first cleaning.

A document is judged line by line, before anything is said about the whole: each line is held against rules
(punctuation, navigation, boilerplate, and repetition of what stood before it in the document). Lines that fail
are removed, and a document that loses too much is rejected. A line repeats if a run of words that already
occurred covers any of it, whether the run lies in the line or reaches over its ends; so the lines that fail by
repetition hold all repeated words, and no document whose repeated share reaches a limit loses less than
that limit. Their exact share is counted in the same walk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W_]+")
#: Words beyond which runs are compared by sorting instead of hashing tuples, to hold less memory.
LONG = 50_000


def words(text: str) -> list[str]:
    """Runs of letters or digits, in lower case."""
    return WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in WORD.findall(text)]


def covered_words(tokens: list[str], run: int = 5) -> list[tuple[int, int]]:
    """Ranges (from, to) of the words that lie in a run of ``run`` words which also starts at an earlier word; apart and in order."""
    n = len(tokens) - run + 1
    if n < 2:
        return []
    if len(tokens) > LONG:
        return _covered_by_sorting(tokens, run)
    seen: set[tuple[str, ...]] = set()
    ranges: list[tuple[int, int]] = []
    for i, gram in enumerate(zip(*(tokens[k:] for k in range(run)))):
        if gram not in seen:
            seen.add(gram)
        elif ranges and ranges[-1][1] >= i:
            ranges[-1] = (ranges[-1][0], i + run)
        else:
            ranges.append((i, i + run))
    return ranges


def _covered_by_sorting(tokens: list[str], run: int) -> list[tuple[int, int]]:
    number: dict[str, int] = {}
    rank, width = np.fromiter((number.setdefault(w, len(number)) for w in tokens), np.int64, len(tokens)), 1
    while width < run:  # names of runs of growing width, by pairs of names: exact
        step = min(width, run - width)
        left, right = rank[: len(rank) - step], rank[step:]
        rank = np.unique(left * (int(rank.max()) + 1) + right, return_inverse=True)[1]
        width += step
    first = np.unique(rank, return_index=True)[1]
    again = np.ones(len(rank), bool)
    again[first] = False
    marks = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(again), 1)
    np.add.at(marks, np.flatnonzero(again) + run, -1)
    inside = np.concatenate([[0], (np.cumsum(marks)[:-1] > 0).astype(np.int8), [0]])
    edges = np.diff(inside)
    return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()))


def repeated_words(tokens: list[str], run: int = 5) -> int:
    """Words that lie in a run of ``run`` words which also starts at an earlier word."""
    return sum(b - a for a, b in covered_words(tokens, run))


#: Rules of single lines, by name: a line that matches as a whole fails. Lines are the text between line breaks.
LINE_RULES = {
    # no letter or digit at all
    "punctuation": re.compile(r"[\W_]+"),
    # three or more short segments between bars, arrows or bullets, steps to other pages, page numbers
    "navigation": re.compile(
        r"\W*\w[\w '&-]{0,24}(?:\s*[|>»›•·]\s*\w[\w '&-]{0,24}){2,}\W*"
        r"|\W*(?:home|menu|next|previous|prev|back|top|back to (?:top|start|contents)|table of contents|contents|page \d+(?: (?:of|/) \d+)?|\d+ ?/ ?\d+)\W*",
        re.I,
    ),
    # markup alone, notices, calls to sign up, share or accept
    "boilerplate": re.compile(
        r"(?:\s*<[^<>]*>\s*)+"
        r"|\W*(?:copyright\b.{0,80}|(?:©|\(c\)) ?\d{4}.{0,80}|.{0,60}all rights reserved)\W*"
        r"|\W*(?:cookie (?:policy|settings)|privacy policy|terms of (?:use|service)|sign (?:in|up)|log ?in|register|subscribe(?: now| to .{1,40})?|read more|learn more|share this.{0,30}|click here.{0,40}|lorem ipsum.*)\W*",
        re.I,
    ),
}
BREAK = re.compile(r"\r\n|[\n\r\v\f\x1c-\x1e\x85\u2028\u2029]")
_COUNTS = ["n_lines", "n_words", "n_repeated", *(f"by_{r}" for r in LINE_RULES), "by_repetition", "words_lost", "words_repeating"]


def judge_lines(text: str, run: int = 5) -> tuple[dict[str, int], list[str]]:
    """(counts, lines kept) of a text. Blank lines neither fail nor count.

    Counts: lines, words, words in repeated runs, failing lines by rule (the first that fails them), words in failing lines,
    words in lines that repeat.
    """
    counts = dict.fromkeys(_COUNTS, 0)
    lines = text.splitlines()  # the same breaks as BREAK, several times as fast
    if not text or BREAK.match(text[-1]):
        lines.append("")
    found = [words(line) for line in lines]
    ranges = covered_words([w for own in found for w in own], run)
    kept, at, nth = [], 0, 0
    for line, own in zip(lines, found):
        end, repeated = at + len(own), 0
        while nth < len(ranges) and ranges[nth][0] < end:
            repeated += min(end, ranges[nth][1]) - max(at, ranges[nth][0])
            if ranges[nth][1] > end:
                break
            nth += 1
        at = end
        if not line.strip():
            kept.append(line)
            continue
        failed = next((name for name, rule in LINE_RULES.items() if rule.fullmatch(line)), "repetition" if repeated else None)
        counts["n_lines"] += 1
        counts["n_words"] += len(own)
        counts["n_repeated"] += repeated
        counts["words_repeating"] += len(own) if repeated else 0
        if failed:
            counts[f"by_{failed}"] += 1
            counts["words_lost"] += len(own)
        else:
            kept.append(line)
    return counts, kept


def line_verdicts(text: Column, run: int = 5, with_cleaned: bool = False) -> Column:
    """STRUCT of the counts of ``judge_lines`` and, if asked for, the text without failing lines. Null text counts as empty."""
    names = [*_COUNTS, *(["cleaned"] if with_cleaned else [])]
    kind = T.StructType([T.StructField(n, T.StringType() if n == "cleaned" else T.LongType()) for n in names])

    @F.arrow_udf(kind)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns: dict[str, list] = {n: [] for n in names}
            for x in batch:
                counts, kept = judge_lines(x.as_py() or "", run)
                for n, v in counts.items():
                    columns[n].append(v)
                if with_cleaned:
                    columns["cleaned"].append("\n".join(kept))
            yield pa.StructArray.from_arrays([pa.array(v, pa.string() if n == "cleaned" else pa.int64()) for n, v in columns.items()], names)

    return judge(text)


def repeated_share(df: DataFrame, key: str = "doc_id", text: str = "text", run: int = 5) -> DataFrame:
    """``key``, n_words, n_repeated and repeated_share (0 for a document without words) of each document.

    Every row of ``df`` gives a row, repeated keys too. Narrow: no shuffle.
    """
    judged = df.select(F.col(f"`{key}`").alias(key), line_verdicts(F.col(f"`{text}`"), run).alias("_m"))
    return judged.select(key, "_m.n_words", "_m.n_repeated", F.coalesce(F.try_divide("_m.n_repeated", "_m.n_words"), F.lit(0.0)).alias("repeated_share"))


def repetitive_documents(df: DataFrame, key: str = "doc_id", text: str = "text", run: int = 5, least_words: int = 10, least_percent: int = 30) -> DataFrame:
    """Keys of documents of ``least_words`` words or more that are rejected for repetition.

    A document is a candidate if its lines that repeat hold ``least_percent`` per cent or more of its words, and
    is rejected if its repeated words alone do.
    """
    judged = df.select(F.col(f"`{key}`").alias(key), line_verdicts(F.col(f"`{text}`"), run).alias("_m")).select(key, "_m.*")
    candidates = judged.filter((F.col("n_words") >= least_words) & (F.col("words_repeating") * 100 >= F.col("n_words") * least_percent))
    return candidates.filter(F.col("n_repeated") * 100 >= F.col("n_words") * least_percent).select(key)


def clean_lines(df: DataFrame, key: str = "doc_id", text: str = "text", run: int = 5, most_lost_percent: int = 30) -> DataFrame:
    """Line-first cleaning: ``key``, counts of lines, words and failing lines by rule, words_lost, rejected, cleaned.

    A document that loses ``most_lost_percent`` per cent of its words or more is rejected and its cleaned text is null. One
    without words loses nothing; null text is a document without lines. Every row of ``df`` gives a row.
    """
    done = df.select(F.col(f"`{key}`").alias(key), line_verdicts(F.col(f"`{text}`"), run, True).alias("_c")).select(key, "_c.*")
    rejected = (F.col("n_words") > 0) & (F.col("words_lost") * 100 >= F.col("n_words") * most_lost_percent)
    return done.withColumn("rejected", rejected).withColumn("cleaned", F.when(~F.col("rejected"), F.col("cleaned"))).drop("words_repeating")
