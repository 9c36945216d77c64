"""Text cut off by field limits or in transfer.

Each text of a source is whole, cut at a limit, or cut in transfer at any place. Two things are seen of it: its
ending (an open JSON value, a broken word or sentence, or a complete end, after anything that was put behind a cut
has been taken off) and its length. Per source a mixture is fitted by maximum likelihood (EM):

* lengths of whole texts are log-normal, the cut ones being right-censored at their length;
* cuts in transfer hit a text at any place before its end, so their lengths follow the survival function of whole lengths;
* cuts at a limit have a length at which texts pile up far beyond what the distribution of lengths explains;
* prose without the end of a sentence is cut, unless the source writes like that: if such texts have lengths of their
  own, far more alike than cuts in transfer leave them, they are a fourth part, ``plain`` whole texts;
* how often each part shows which ending is fitted too, from beliefs worth a few texts.

The posterior of a text joins its ending and its length. Two things are not fitted: an open value or a mark behind a
broken end is a cut, and a closed value, sentence or label is none, even at a limit, but for misread endings.
Between them, prose without an end and ends in three dots, the fit decides.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.operators.sizing import broadcast_if_small
from examsift.runtime import cut_lineage

#: The parts of the mixture, in order.
PARTS = ["whole", "plain", "limit", "transfer"]
#: Beliefs, in texts, about the endings of each part; ``+`` is a mark (an ellipsis, say) behind a broken end.
#: ``trailing`` are three dots right behind a word: a mark of a cut at a limit, or a way of writing.
BELIEFS = [
    {"closed": 40.0, "sentence": 40.0, "label": 12.0, "trailing": 5.0, "empty": 2.0},
    {"word": 1.0},
    {"value": 4.0, "word": 4.0, "string": 1.0, "value+": 1.0, "word+": 1.0, "string+": 0.5, "trailing": 1.0},
    {"value": 5.0, "word": 5.0, "string": 1.0, "value+": 0.2, "word+": 0.2, "string+": 0.2},
]
#: Shares of endings that a part shows by mistake; kept, not fitted.
MISREAD = [
    {"word": 1e-4, "value": 1e-6, "string": 1e-6, "word+": 1e-6, "value+": 1e-6, "string+": 1e-6},
    {},
    {"sentence": 1e-6, "label": 1e-6, "closed": 1e-6, "empty": 1e-9},
    {"sentence": 1e-6, "label": 1e-6, "closed": 1e-6, "empty": 1e-9, "trailing": 1e-3},
]
ENDS = ["closed", "sentence", "label", "trailing", "empty", "word", "string", "value", "word+", "string+", "value+"]
#: Texts in a hundred that are believed to be cut before any is seen, and the least share of cuts a source is credited with.
BELIEVED, LEAST_SHARE = 1.0, 0.002
#: Texts without an end that a source needs at least to have a plain part, and the gain in log-likelihood each brings then on average.
LEAST_PLAIN, GAIN = 20, 1.0
#: Kinds that count as censored at the start.
BROKEN_ENDS = ("value", "word", "string")
#: A length is a candidate limit if it has at least LEAST texts and TIMES as many as expected and as its neighbours have.
LEAST, TIMES = 8, 5.0
#: Share of broken ends, or of ends in three dots, that a candidate limit shows at least; lengths of set phrases show next to none.
BROKEN = 0.2
#: Lengths up to EXACT are counted singly, and longer ones where texts pile up; other longer ones in bins of one part
#: in 200, so a source has a bounded number of bins.
EXACT = 8192

#: Characters at the end of a text in which marks and labels are looked for.
TAIL = 120
MARKS = re.compile(r"(?:\s*(?:…|\.{3,}|\[\s*(?:…|\.{3}|truncated|cut off|continued)\s*\]|\(\s*(?:…|\.{3}|truncated|cut off|continued)\s*\)|<\s*truncated\s*>))+\s*$", re.I)
#: Characters that a mark can end with: without one of them none is looked for.
MARK_ENDS = frozenset("….])>")
#: Three dots right behind a word.
TRAILING = re.compile(r"\w\.\.\.\s*$")
DOTS = re.compile(r"\.\.\.\s*$")
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\\?$)|[{}\[\]]', re.S)
START = re.compile(r'\{(?=\s*(?:["}\w\']|$))|\[(?=\s*(?:[\[{"\]]|$))')
FENCE = re.compile(r"\s*`{1,3}\w*\s*$")
SENTENCE = re.compile(r"[.!?。؟！？…][\"'”’»)\]*_`]*$")
#: Ends within a JSON string that do not count, and marks there.
BREAKS = re.compile(r"(?:\s|\\[nrt])+$")
ESCAPED = re.compile(r"(?:\\u2026)+$")
#: A sentence end with more text behind it.
INNER = re.compile(r"[.!?][\"'”’)\]]*\s")
KEY = re.compile(r'"(\w+)"\s*:\s*$')
#: Keys of prose: their strings are sentences from SHORT words on; those of other keys from LONG words on, and
#: those of choices and passages (NAMED) and of lists if they have a sentence end inside too.
PROSE, NAMED, SHORT, LONG = {"explanation", "rationale", "reason", "reasoning", "stem", "stimulus", "passage"}, {"text", "label"}, 2, 6
LABEL = re.compile(r"(?:^|:\s*)\(?[A-F]\)?(?:\s*(?:,|;|&|and|\s)\s*\(?[A-F]\)?)*$")


def ending(text: str) -> tuple[str, bool, int]:
    """(kind of end, whether a mark stood behind it, length without the mark)."""
    bare = text.strip()
    if not bare:
        return "empty", False, len(text)
    tail = text[-TAIL:]
    mark = MARKS.search(tail) if bare[-1] in MARK_ENDS else None
    if mark and TRAILING.search(tail):
        mark = None
    size = len(text)
    if mark and not SENTENCE.search(tail[: mark.start()].rstrip()[-16:]):
        content, marked = text[: len(text) - len(tail) + mark.start()], True
        # white space before a mark was cut with the text, but for the one space that leads a mark in brackets
        sign = mark[0].lstrip()
        size = len(content) + max(0, len(mark[0]) - len(sign) - (sign[0] in "[(<"))
    else:
        content, marked = text, False
    kind = _kind(content.strip())
    if kind == "closed" and (inside := _last_string(content)):
        return inside
    # three dots may stand behind a cut: the length is looked up without them
    return kind, marked, len(DOTS.sub("", content)) if kind == "trailing" else size


def _last_string(content: str) -> tuple[str, bool, int] | None:
    """The same for the last string of a closed JSON value with only closers, fences and marks behind it, up to the
    end of the string; None if there is none or it is no broken prose."""
    bare = content.rstrip()
    while (bare[-1:] in MARK_ENDS or "`" in bare[-TAIL:]) and (shorter := MARKS.sub("", FENCE.sub("", bare[-TAIL:]))) != bare[-TAIL:]:
        bare = (bare[:-TAIL] + shorter).rstrip()
    bare = bare.rstrip(" \t\r\n]}")
    if not bare.endswith('"'):
        return None
    end = at = len(bare) - 1
    while (at := bare.rfind('"', 0, at)) >= 0:
        before = bare[max(0, at - TAIL) : at]
        if (len(before) - len(before.rstrip("\\"))) % 2 == 0:
            break
    if at < 0:
        return None
    text = BREAKS.sub("", bare[at + 1 : end])
    tail = text[-TAIL:]
    mark = None if TRAILING.search(tail) else MARKS.search(tail) or ESCAPED.search(tail)
    if mark:
        text = text[: len(text) - len(tail) + mark.start()]
        end = at + 1 + len(text)
    key, words = KEY.search(before), len(text.split())
    if key and key[1] not in NAMED:
        prose = words >= (SHORT if key[1] in PROSE else LONG)
    else:
        prose = words >= LONG and bool(INNER.search(text))
    last = text[-TAIL:].replace('\\"', '"')
    if not prose:
        return None
    if SENTENCE.search(last[-16:]):
        return ("trailing", False, at + 1 + len(DOTS.sub("", text))) if TRAILING.search(last) else None
    return None if LABEL.search(last) else ("string", mark is not None, end)


def _unfenced(text: str) -> str:
    bare = text.rstrip()
    return (bare[:-40] + FENCE.sub("", bare[-40:])).strip()


def _kind(content: str) -> str:
    if not content:
        return "word"
    if content[0] in "{[":
        try:
            json.loads(content)
            return "closed"
        except (ValueError, RecursionError):
            pass
    at, end = 0, None
    while start := START.search(content, at):
        depth = 0
        for token in TOKEN.finditer(content, start.start()):
            x = token.group()
            if x in "{[":
                depth += 1
            elif x in "}]":
                depth -= 1
                if not depth:
                    at = end = token.end()
                    break
            elif len(x) < 2 or x[-1] != '"':
                return "value"
        else:
            return "value"
    rest = _unfenced(content[end:] if end else content)
    if not rest:
        return "closed" if end else "word"
    rest = rest[-TAIL:]
    if end and MARKS.fullmatch(rest):
        return "closed"
    if SENTENCE.search(rest[-16:]):
        return "trailing" if rest.endswith("...") else "sentence"
    return "label" if LABEL.search(rest) else "word"


def endings(text: Column) -> Column:
    """STRUCT<kind, marked, n_chars> of each text; null for a null text."""

    @F.arrow_udf(T.StructType([T.StructField("kind", T.StringType()), T.StructField("marked", T.BooleanType()), T.StructField("n_chars", T.LongType())]))
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, kinds = ["kind", "marked", "n_chars"], [pa.string(), pa.bool_(), pa.int64()]
        for batch in batches:
            rows = [(None, None, None) if not x.is_valid else ending(x.as_py()) for x in batch]
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return look(text)


def fit_censored(lengths: np.ndarray, weights: np.ndarray, censored: np.ndarray, start: tuple[float, float] | None = None, rounds: int = 200) -> tuple[float, float]:
    """(mu, sigma) of the log-normal that maximises the likelihood of whole lengths and of right-censored ones (EM, from ``start`` if given)."""
    y, whole = np.log(np.maximum(lengths, 1.0)), ~censored
    use = weights[whole].sum() > 0
    if start and use:
        mu, sigma = start
    else:
        mu = float(np.average(y[whole], weights=weights[whole])) if use else float(np.average(y, weights=weights))
        sigma = max(0.05, float(np.sqrt(np.average((y - mu) ** 2, weights=weights))))
    total = weights.sum()
    # whole lengths enter by their sums, which no round changes
    once, twice = float((weights[whole] * y[whole]).sum()), float((weights[whole] * y[whole] ** 2).sum())
    y, weights = y[censored], weights[censored]
    for _ in range(rounds if censored.any() and use else 0):
        z = (y - mu) / sigma
        hazard = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) / np.maximum(_survival(z), 1e-12)
        hazard = np.where(z > 6, z + 1 / np.maximum(z, 1), hazard)  # its limit where the tail underflows
        first = mu + sigma * hazard
        second = mu * mu + sigma * sigma + sigma * (y + mu) * hazard
        new_mu = (once + float((weights * first).sum())) / total
        new_sigma = max(0.05, math.sqrt(max(1e-6, (twice + float((weights * second).sum())) / total - new_mu * new_mu)))
        moved = abs(new_mu - mu) + abs(new_sigma - sigma)
        mu, sigma = new_mu, new_sigma
        if moved < 1e-6:
            break
    return mu, sigma


def _survival(z: np.ndarray) -> np.ndarray:
    """Share of a standard normal above ``z``."""
    return np.maximum(np.vectorize(math.erfc, otypes=[float])(z / math.sqrt(2)) / 2, 1e-300)


def _candidates(lengths: np.ndarray, counts: np.ndarray, broken: np.ndarray, width: np.ndarray, mu: float, sigma: float) -> list[int]:
    """Lengths at which texts, broken ones among them, pile up beyond the distribution and their neighbours."""
    y = np.log(np.maximum(lengths, 1))
    expected = counts.sum() * np.exp(-(((y - mu) / sigma) ** 2) / 2) / (np.maximum(lengths, 1) * sigma * math.sqrt(2 * math.pi))
    found = []
    for i in np.flatnonzero((width == 1) & (counts >= LEAST) & (broken >= BROKEN * counts) & (counts >= TIMES * expected)):
        near = (np.abs(lengths - lengths[i]) <= 25) & (lengths != lengths[i])
        beside = np.zeros(10)  # the five lengths on each side
        close = np.flatnonzero((np.abs(lengths - lengths[i]) <= 5) & near)
        beside[: len(close)] = counts[close]
        if counts[i] >= TIMES * max(counts[near].sum() / np.maximum(50, width[near].sum()), float(np.median(beside)), 0.2):
            found.append(int(lengths[i]))
    return found


def fit_source(ends: np.ndarray, lengths: np.ndarray, counts: np.ndarray, width: np.ndarray) -> dict:
    """The mixture of one source from counts by (number of ending, length): shares, log-normal, limits with their weights, shares of endings."""
    names = np.array(ENDS)[ends]
    broken = np.array([n.rstrip("+") in BROKEN_ENDS for n in names.tolist()])
    mu, sigma = fit_censored(lengths, counts, broken)
    at, where = np.unique(lengths, return_inverse=True)
    may = broken | (names == "trailing")
    limits = _candidates(at, np.bincount(where, counts), np.bincount(where, counts * may), np.maximum.reduceat(width[np.argsort(where, kind="stable")], np.searchsorted(np.sort(where), np.arange(len(at)))), mu, sigma)
    place = np.array([limits.index(x) if x in set(limits) else -1 for x in lengths.tolist()])

    def shares(belief: dict[str, float], fitted: np.ndarray) -> np.ndarray:
        fixed = np.array([0.0 if e in belief else MISREAD.get(e, 0.0) for e in ENDS])
        free = np.array([belief.get(e, 0.0) for e in ENDS]) + np.where(fixed > 0, 0.0, fitted)
        return fixed + free / free.sum() * (1 - fixed.sum())

    def shares(part: int, fitted: np.ndarray) -> np.ndarray:
        fixed = np.array([MISREAD[part].get(e, 0.0) for e in ENDS])
        free = np.array([BELIEFS[part].get(e, 0.0) for e in ENDS]) + np.where([e in BELIEFS[part] for e in ENDS], fitted, 0.0)
        return fixed + free / free.sum() * (1 - fixed.sum())

    def log_normal(mu: float, sigma: float) -> np.ndarray:
        return np.exp(-(((y - mu) / sigma) ** 2) / 2) / (np.maximum(lengths, 1.0) * sigma * math.sqrt(2 * math.pi))

    def in_transfer(mu: float, sigma: float) -> np.ndarray:
        return _survival((y - mu) / sigma) / math.exp(min(50.0, mu + sigma * sigma / 2))

    y, total = np.log(np.maximum(lengths, 1.0)), counts.sum()
    theta = [shares(k, np.zeros(len(ENDS))) for k in range(len(PARTS))]
    weights = np.full(len(limits), 1.0 / max(1, len(limits)))
    plain_mu = plain_sigma = 1.0
    open_prose = (names == "word") & (place < 0)
    has_plain = counts[open_prose].sum() >= LEAST_PLAIN
    if has_plain:
        n = counts[open_prose]
        plain_mu = float(np.average(y[open_prose], weights=n))
        plain_sigma = max(0.05, float(np.sqrt(np.average((y[open_prose] - plain_mu) ** 2, weights=n))))
        gain = np.log(np.maximum(log_normal(plain_mu, plain_sigma), 1e-300)) - np.log(np.maximum(in_transfer(mu, sigma), 1e-300))
        has_plain = float(np.average(gain[open_prose], weights=n)) > GAIN
    cut = counts[broken].sum()
    mix = np.array([max(1.0, total - cut), cut / 2 if has_plain else 0.0, cut / 2 + BELIEVED, cut / 2 + BELIEVED])
    mix /= mix.sum()
    for _ in range(12):
        at_limit = np.where(place >= 0, weights[place] if len(weights) else 0.0, 0.0)
        density = [log_normal(mu, sigma), log_normal(plain_mu, plain_sigma), at_limit, in_transfer(mu, sigma)]
        like = np.stack([m * d * t[ends] for m, d, t in zip(mix, density, theta)])
        resp = like / np.maximum(like.sum(axis=0), 1e-300) * counts
        mix = resp.sum(axis=1) + np.array([100.0, 0.0, BELIEVED, BELIEVED])
        mix /= mix.sum()
        mix[2:] = np.maximum(mix[2:], LEAST_SHARE)
        mix /= mix.sum()
        theta = [shares(k, np.bincount(ends, r, len(ENDS))) for k, r in enumerate(resp)]
        if len(limits):
            weights = np.bincount(place[place >= 0], resp[2][place >= 0], len(limits)) + 0.5
            weights /= weights.sum()
        if has_plain and resp[1].sum() > 1:
            plain_mu = float(np.average(y, weights=resp[1]))
            plain_sigma = max(0.05, float(np.sqrt(np.average((y - plain_mu) ** 2, weights=resp[1]))))
        worth = np.concatenate([resp[0], resp[2] + resp[3]])
        keep = worth > 1e-6
        if keep.any():
            mu, sigma = fit_censored(np.concatenate([lengths, lengths])[keep], worth[keep], np.repeat([False, True], len(lengths))[keep], (mu, sigma), 5)
    return {"mu": mu, "sigma": sigma, "plain_mu": plain_mu, "plain_sigma": plain_sigma, "mix": mix.tolist(), "theta": [t.tolist() for t in theta], "limits": limits, "weights": weights.tolist()}


_FIT = "mu double, sigma double, plain_mu double, plain_sigma double, mix array<double>, theta array<array<double>>, limits array<bigint>, weights array<double>"


def _fit_group(group: pd.DataFrame) -> pd.DataFrame:
    """Of one source's counts by ending and length."""
    ends = group["end"].map({e: i for i, e in enumerate(ENDS)}).to_numpy(np.int64)
    fit = fit_source(ends, group["cell"].to_numpy(float), group["n"].to_numpy(float), group["width"].to_numpy(float))
    return pd.DataFrame([{"tbl": group["tbl"].iloc[0], "source": group["source"].iloc[0], **fit}])


def _counts(seen: DataFrame) -> DataFrame:
    """(tbl, source, end, cell, width, n): texts by ending and length; ``width`` is the number of lengths a cell stands for."""
    end = F.concat("kind", F.when(F.col("marked") & F.col("kind").isin(*BROKEN_ENDS), "+").otherwise(""))
    single = cut_lineage(seen.filter("n_chars > 0").groupBy("tbl", "source", end.alias("end"), "n_chars").agg(F.count(F.lit(1)).alias("n")))
    whole = single.withColumns({"cell": F.col("n_chars"), "width": F.lit(1).cast("long")})
    if (single.agg(F.max("n_chars")).first()[0] or 0) > EXACT:
        step = F.round(F.log(F.col("n_chars") / F.lit(EXACT)) * 200) / 200
        binned = whole.withColumn("_bin", F.when(F.col("n_chars") > EXACT, step))
        wide = F.greatest(F.lit(1.0), F.lit(EXACT / 200) * F.exp("_bin"))
        same = F.col("tbl").eqNullSafe(F.col("_t")) & F.col("source").eqNullSafe(F.col("_s"))
        totals = binned.filter("_bin is not null").groupBy(F.col("tbl").alias("_t"), F.col("source").alias("_s"), F.col("_bin").alias("_b")).agg(F.sum("n").alias("_all"))
        piled = binned.filter("_bin is not null").groupBy("tbl", "source", "n_chars", "_bin").agg(F.sum("n").alias("_at"))
        piled = piled.join(totals, same & (F.col("_bin") == F.col("_b"))).filter((F.col("_at") >= LEAST) & (F.col("_at") * wide >= TIMES * F.col("_all")))
        piled = piled.select(F.col("tbl").alias("_t"), F.col("source").alias("_s"), F.col("n_chars").alias("_c"), F.lit(True).alias("_piled"))
        joined = binned.join(piled, same & (F.col("n_chars") == F.col("_c")), "left")
        alone = F.col("_bin").isNull() | F.col("_piled")
        whole = joined.withColumns({"cell": F.when(alone, F.col("n_chars")).otherwise(F.round(EXACT * F.exp("_bin")).cast("long")), "width": F.when(alone, 1).otherwise(F.ceil(wide)).cast("long")})
    return whole.groupBy("tbl", "source", "end", "cell", "width").agg(F.sum("n").alias("n"))


def _tail(z: Column) -> Column:
    """Share of a standard normal above ``z``, to seven places (a rational approximation of the error function)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    upper = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x) / 2
    return F.when(z >= 0, upper).otherwise(1 - upper)


def judge_endings(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (tbl, row_key, source, text): (tbl, row_key, source, kind, posterior, log_odds, truncated, by_ending) of each text, and the fit of each source.

    ``truncated`` is the judgement of ending and length together, ``by_ending`` that of the ending alone. Texts are read once;
    what is written is a few bytes a row. The fit works on counts by (tbl, source, ending, length), combined before
    their shuffle, of bounded size per source. A null source is a source of its own. Null texts are never truncated
    and count in no fit; empty ones are complete.
    """
    seen = texts.select("tbl", "row_key", "source", endings(F.col("text")).alias("_e"))
    seen = cut_lineage(seen.select("tbl", "row_key", "source", "_e.kind", "_e.marked", "_e.n_chars"))
    fits = cut_lineage(_counts(seen).groupBy("tbl", "source").applyInPandas(_fit_group, f"tbl string, source string, {_FIT}"))
    # what every text of a source needs is worked out once per source: the parts' shares of each ending, the limits, the mean
    shares = F.transform(F.array(*[F.lit(i) for i in range(len(ENDS))]), lambda e: F.transform("theta", lambda t, k: F.get(t, e) * F.get("mix", k)))
    mean = F.exp(F.least(F.lit(50.0), F.col("mu") + F.col("sigma") * F.col("sigma") / 2))
    known = fits.select(
        F.col("tbl").alias("_t"), F.col("source").alias("_s"), "mu", "sigma", "plain_mu", "plain_sigma", mean.alias("mean"),
        F.map_from_arrays(F.array(*map(F.lit, ENDS)), shares).alias("shares"), F.map_from_arrays("limits", "weights").alias("at"),
    )
    joined = seen.join(broadcast_if_small(cut_lineage(known)), (F.col("tbl") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")), "left")
    end = F.concat("kind", F.when(F.col("marked") & F.col("kind").isin(*BROKEN_ENDS), "+").otherwise(""))
    parts = joined.withColumns({"_share": F.try_element_at("shares", end), "_y": F.log(F.greatest(F.col("n_chars"), F.lit(1)))})

    def log_normal(mu: str, sigma: str) -> Column:
        z = (F.col("_y") - F.col(mu)) / F.col(sigma)
        return F.exp(-z * z / 2 - F.col("_y")) / (F.col(sigma) * math.sqrt(2 * math.pi))

    densities = [
        log_normal("mu", "sigma"),
        log_normal("plain_mu", "plain_sigma"),
        F.coalesce(F.try_element_at("at", F.col("n_chars")), F.lit(0.0)),
        _tail((F.col("_y") - F.col("mu")) / F.col("sigma")) / F.col("mean"),
    ]
    parts = parts.withColumns({f"_s_{c}": F.get("_share", F.lit(k)) for k, c in enumerate(PARTS)})
    parts = parts.withColumns({f"_{c}": F.col(f"_s_{c}") * d for c, d in zip(PARTS, densities)} | {"_alone": F.col("_s_limit") + F.col("_s_transfer") - F.col("_s_whole") - F.col("_s_plain")})
    cut, whole = F.col("_limit") + F.col("_transfer") + F.lit(1e-300), F.col("_whole") + F.col("_plain") + F.lit(1e-300)
    counted = F.coalesce(F.col("kind") != "empty", F.lit(False))
    judged = parts.withColumns({"posterior": F.when(counted, cut / (cut + whole)).otherwise(0.0), "log_odds": F.when(counted, F.log(cut / whole))})
    return judged.select("tbl", "row_key", "source", "kind", "posterior", "log_odds", F.coalesce(counted & (F.col("log_odds") > 0), F.lit(False)).alias("truncated"), F.coalesce(counted & (F.col("_alone") > 0), F.lit(False)).alias("by_ending")), fits


def generated_texts(raw_generations: DataFrame, solver_responses: DataFrame) -> DataFrame:
    """(tbl, row_key, source, text) of the two tables that hold model output."""
    a = raw_generations.select(F.lit("raw_generations").alias("tbl"), F.col("gen_id").alias("row_key"), F.col("model_name").alias("source"), F.col("generation").alias("text"))
    return a.unionByName(solver_responses.select(F.lit("solver_responses").alias("tbl"), F.col("resp_id").alias("row_key"), F.col("model").alias("source"), F.col("generation").alias("text")))


def truncated_rows(texts: DataFrame) -> DataFrame:
    """(tbl, row_key) of texts judged cut off."""
    return judge_endings(texts)[0].filter("truncated").select("tbl", "row_key")


def truncation_rates(texts: DataFrame) -> DataFrame:
    """Per (tbl, source): texts, truncated texts and their rate, how many judgements the lengths changed, and the fit with its limits."""
    judged, fits = judge_endings(texts)
    changed = F.col("truncated") != F.col("by_ending")
    rates = judged.groupBy("tbl", "source").agg(F.count("kind").alias("texts"), F.count_if("truncated").alias("truncated"), F.count_if(changed).alias("by_length"))
    rates = rates.withColumn("rate", F.coalesce(F.try_divide("truncated", "texts"), F.lit(0.0)))
    named = fits.select(F.col("tbl").alias("_t"), F.col("source").alias("_s"), "mu", "sigma", F.array_sort("limits").alias("limits"))
    return rates.join(named, (F.col("tbl") == F.col("_t")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_t", "_s")
