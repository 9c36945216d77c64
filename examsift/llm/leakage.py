"""Evaluation texts leaking into training texts: containment search and exact verification.

The search follows the size-partitioned MinHash ensemble. The query side are windows of ``span`` words
of each held-out passage. The other side are the texts' domains: a text of few shingles is one domain,
a longer one is cut into overlapping domains of bounded size, so that any window lies in one of them
and the sizes of query and domain stay comparable. Domains are partitioned by size; the size bound of a
partition turns the containment wanted into a Jaccard and so into the number of agreeing signature
coordinates that makes a candidate. Candidates are checked by exact shingle containment, and what is
left by aligning the words. In passages with blanks each filled blank breaks more shingles, so these passages
are not estimated: the shingles that a text shares with them are counted within the stretch of a leak.

Words are compared in lower case. Markup tags, quotation marks of lines, zero-width characters and
escapes of JSON strings do not count, and what stands in a blank of a passage is free.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.llm.near_duplicates import WordHash, mix, shingles, shingles_of
from examsift.runtime import cut_lineage, worker_state

WIDTH = 3
#: Signature coordinates.
COORDINATES = 64
#: Passages that are searched for at once; more are searched in blocks.
PASSAGES_AT_ONCE = 2_000
#: Texts whose shingles are hashed together.
TEXTS_AT_ONCE = 128
#: Largest difference of positions by which an alignment may drift, and words that may fill a blank.
DRIFT, FILL = 6, 4

WORD = re.compile(r"[^\W_]+")
BLANK = re.compile(r"\[\s*blank[\s_]*\d*\s*\]|_{2,}")
#: Tags with attributes of any length; what else stands between angle brackets, if it is short.
MARKUP = re.compile(r"""</?[A-Za-z][\w:.-]*(?:\s+[\w:.-]+(?:\s*=\s*(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>]+))?)*\s*/?>|<[^<>]{1,200}>""")
ESCAPE = re.compile(r"\\[nrt]|\\u00[0-9a-f]{2}")
INVISIBLE = dict.fromkeys([0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])


def clean(text: str) -> str:
    """The text without markup, entities, escapes and blanks, in lower case."""
    if not text.isascii():
        text = text.translate(INVISIBLE)
    if "<" in text:
        text = MARKUP.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text:
        text = ESCAPE.sub(" ", text)
    if "[" in text or "_" in text:
        text = BLANK.sub(" ", text)
    return text.lower()


def passage_words(text: str) -> tuple[list[str], list[int]]:
    """Words of a passage and, after each word, the number of blanks that follow it."""
    words: list[str] = []
    blanks: list[int] = []
    for k, part in enumerate(BLANK.split(MARKUP.sub(" ", html.unescape(text)))):
        if k and words:
            blanks[-1] += 1
        found = WORD.findall(part.translate(INVISIBLE).lower())
        words += found
        blanks += [0] * len(found)
    return words, blanks


def agreements_needed(size: int, query: int, shared: int, coordinates: int, miss: float = 1e-3) -> int:
    """Agreeing coordinates that a domain of at most ``size`` shingles shows with probability 1 - ``miss``
    or more if it has ``shared`` of the ``query`` shingles."""
    likeness = shared / (size + query - shared)
    below, k = 0.0, 0
    while k <= coordinates:
        below += math.comb(coordinates, k) * likeness**k * (1 - likeness) ** (coordinates - k)
        if below > miss:
            break
        k += 1
    return max(1, k)


class PassageIndex:
    """Signatures of all windows of the passages, and the passages for the exact checks."""

    def __init__(self, passages: list[tuple[str, str]], span: int = 20, one_in: int = 8):
        self.span, self.one_in = span, one_in
        self.names = [n for n, _ in passages]
        self.words, self.blanks = map(list, zip(*(passage_words(t) for _, t in passages))) if passages else ([], [])
        self.query = span - WIDTH + 1
        #: Shingles of a window that survive the edits allowed and one blank.
        self.shared = max(3, self.query - (span // one_in) * WIDTH - (WIDTH - 1))
        hash_words = WordHash()
        self.sets = [shingles(hash_words(w), WIDTH) for w in self.words]
        #: Passages with blanks between their words are counted exactly: (shingles that survive, shingles of a text they lie in).
        self.blanked = {o: self._survivors(b) for o, b in enumerate(self.blanks) if len(b) >= span and any(b[:-1])}
        own = [(self.sets[o], np.full(len(self.sets[o]), o, np.int64)) for o in self.blanked]
        self.codes, self.code_owners = (np.concatenate(x) for x in zip(*own)) if own else (np.empty(0, np.uint64), np.empty(0, np.int64))
        by_code = np.argsort(self.codes, kind="stable")
        self.codes, self.code_owners = self.codes[by_code], self.code_owners[by_code]
        self.code_bits = np.zeros(1 << 22, bool)
        self.code_bits[(self.codes >> np.uint64(42)).astype(np.int64)] = True
        rng = np.random.default_rng(20)
        self.factors = rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        keys, owners = [], []
        with np.errstate(over="ignore"):
            for k, factor in enumerate(self.factors):
                for owner, s in enumerate(self.sets):
                    if len(s) and owner not in self.blanked:
                        values = s * factor
                        least = np.lib.stride_tricks.sliding_window_view(values, min(self.query, len(s))).min(axis=1)
                        least = np.unique(least)
                        keys.append(self.key(least, k))
                        owners.append(np.full(len(least), owner, np.int32))
        key = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        owner = np.concatenate(owners) if owners else np.empty(0, np.int32)
        order = np.argsort(key, kind="stable")
        self.keys, self.owners = key[order], owner[order]
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.members = [set(s.tolist()) for s in self.sets]
        self.places: list[dict[str, list[int]]] = []
        for w in self.words:
            at: dict[str, list[int]] = {}
            for i, x in enumerate(w):
                at.setdefault(x, []).append(i)
            self.places.append(at)
        #: Partitions of domain sizes by their bounds, and the agreements each needs.
        self.segment = self.query
        self.bounds = [self.segment // 2, self.segment, self.segment * 3 // 2, self.segment * 2]
        self.needed = [agreements_needed(b, self.query, self.shared, COORDINATES) for b in self.bounds]

    def _survivors(self, blanks: list[int]) -> tuple[int, int]:
        """(fewest shingles that a leak of the passage keeps, most shingles of a text that it stretches over).

        A filled blank breaks the shingles over it and an edit WIDTH more. Of a leak of twice the span
        or more one half is a leak itself, so windows of one to two spans are all that count. One shingle
        at least is asked for.
        """
        blank = np.array(blanks)
        broken = np.concatenate([[0], np.cumsum(np.lib.stride_tricks.sliding_window_view(blank[:-1] > 0, WIDTH - 1).any(axis=1))])
        filled = np.concatenate([[0], np.cumsum(blank)])
        fewest, widest = self.query, 0
        for n in range(self.span, min(2 * self.span, len(blanks) + 1)):
            at, size, edits = np.arange(len(blanks) - n + 1), n - WIDTH + 1, n // self.one_in
            fewest = min(fewest, size - edits * WIDTH - int((broken[at + size] - broken[at]).max()))
            widest = max(widest, size + edits + FILL * int((filled[at + n - 1] - filled[at]).max()))
        return max(1, fewest), widest

    def counted(self, sets: list[np.ndarray]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """For each text (by number) the passages with blanks, and ranges of its shingles that hold as many of the passage's
        as every leak keeps: exact."""
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        if not len(self.codes) or not sum(map(len, sets)):
            return found
        whole = np.concatenate(sets)
        hit = np.flatnonzero(self.code_bits[(whole >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(self.codes, whole[hit]), np.searchsorted(self.codes, whole[hit], "right")
        n = hi - lo
        where = np.repeat(hit, n)
        who = self.code_owners[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        text = np.searchsorted(offsets, where, "right") - 1
        pair = text * len(self.names) + who
        placed = np.unique(np.stack([pair, where]), axis=1) if len(pair) else np.empty((2, 0), np.int64)
        pair, where = placed
        firsts = np.flatnonzero(np.diff(pair, prepend=-1))
        lasts = np.append(firsts[1:], len(pair))
        least = np.array([self.blanked.get(o, (0, 0))[0] for o in range(len(self.names))])
        enough = lasts - firsts >= least[pair[firsts] % len(self.names)]
        for first, last in zip(firsts[enough].tolist(), lasts[enough].tolist()):
            t, owner = divmod(int(pair[first]), len(self.names))
            fewest, widest = self.blanked[owner]
            at = where[first:last] - offsets[t]
            ends = np.searchsorted(at, at + widest)
            passed = -1
            for start in at[ends - np.arange(len(at)) >= fewest].tolist():
                if start > passed:
                    found.setdefault(t, {}).setdefault(owner, []).append((max(0, start - widest + fewest), start + widest))
                    passed = start + self.span  # leaks from there on still lie in the words that are aligned
        return found

    @staticmethod
    def key(values: np.ndarray, coordinate: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(values + np.uint64(coordinate + 1) * np.uint64(0x9E3779B97F4A7C15))

    def candidates(self, sets: list[np.ndarray]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """For each text (by number) the passages and domains (shingle ranges) in which enough coordinates agree."""
        sizes = [len(s) for s in sets]
        if not len(self.keys) or not sum(sizes):
            return {}
        starts, text_of, last = [], [], []
        at = 0
        for n, size in enumerate(sizes):
            for lo in range(0, size, self.segment):
                starts.append(at + lo)
                text_of.append(n)
                last.append(lo + self.segment >= size)
            at += size
        ends = np.append(np.array(starts[1:], np.int64), at)
        starts_a, last_a = np.array(starts, np.int64), np.array(last)
        nexts = np.where(last_a, np.arange(len(starts)), np.arange(len(starts)) + 1)
        whole = np.concatenate(sets)
        size_of = ends[nexts] - starts_a
        need = np.array(self.needed)[np.minimum(np.searchsorted(self.bounds, size_of), len(self.bounds) - 1)]
        where, who = [], []
        with np.errstate(over="ignore"):
            for k, factor in enumerate(self.factors):
                least = np.minimum.reduceat(whole * factor, starts_a)
                key = self.key(np.minimum(least, least[nexts]), k)
                hit = np.flatnonzero(self.bits[(key >> np.uint64(42)).astype(np.int64)])
                if len(hit):
                    lo, hi = np.searchsorted(self.keys, key[hit]), np.searchsorted(self.keys, key[hit], "right")
                    n = hi - lo
                    if n.any():
                        where.append(np.repeat(hit, n))
                        who.append(self.owners[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)])
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        if where:
            pair = np.concatenate(where) * len(self.names) + np.concatenate(who)
            pair, agreed = np.unique(pair, return_counts=True)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            for p, c in zip(pair.tolist(), agreed.tolist()):
                domain, owner = divmod(p, len(self.names))
                if c >= need[domain]:
                    text = text_of[domain]
                    base = int(offsets[text])
                    found.setdefault(text, {}).setdefault(owner, []).append((int(starts_a[domain]) - base, int(ends[nexts[domain]]) - base))
        return found

    def contained(self, owner: int, codes: list[int]) -> int:
        """Distinct shingles of the passage among ``codes``: exact containment of the domain."""
        return len(self.members[owner].intersection(codes))

    def aligned(self, owner: int, words: list[str]) -> tuple[int, int]:
        """(words of the passage reproduced, edits) of the best window: the longest that keeps to one edit in
        ``one_in`` words, else the longest run found."""
        place, passage, blanks = self.places[owner], self.words[owner], self.blanks[owner]
        diagonal: Counter[int] = Counter()
        pairs: dict[int, list[int]] = {}
        for t, w in enumerate(words):
            for s in place.get(w, ()):
                diagonal[s - t] += 1
                pairs.setdefault(s - t, []).append(t)
        best = (0, 0)
        drift = DRIFT + FILL * max(0, sum(blanks[:-1]) - 1)
        # a window of span words keeps all but one in one_in of them, on diagonals within the drift
        least = self.span - self.span // self.one_in
        at = sorted(diagonal)
        upto = np.concatenate([[0], np.cumsum([diagonal[d] for d in at])])
        lo, hi = np.searchsorted(at, np.array(at) - drift), np.searchsorted(at, np.array(at) + drift, "right")
        enough = np.flatnonzero(upto[hi] - upto[lo] >= least).tolist() if at else []
        for d in sorted((at[i] for i in enough), key=lambda d: -diagonal[d]):
            best = max(best, self._chain(passage, blanks, pairs, d, drift), key=lambda x: (x[0] >= self.span, x[0]))
            if best[0] >= self.span:
                break
        return best

    def _chain(self, passage: list[str], blanks: list[int], pairs: dict[int, list[int]], around: int, drift: int = DRIFT) -> tuple[int, int]:
        runs = []  # (first word of the passage, first word of the text, length), maximal
        for d in range(around - drift, around + drift + 1):
            at = pairs.get(d)
            if not at:
                continue
            first = prior = at[0]
            for t in at[1:]:
                if t != prior + 1:
                    runs.append((first + d, first, prior - first + 1))
                    first = t
                prior = t
            runs.append((first + d, first, prior - first + 1))
        runs.sort()
        filled = [0]
        for b in blanks:
            filled.append(filled[-1] + b)
        best = (0, 0)
        for i, (s0, _, _) in enumerate(runs):
            cost = {i: 0}
            for j in range(i, len(runs)):
                if j not in cost:
                    continue
                s, t, n = runs[j]
                e, length = cost[j], s + n - s0
                if e * self.one_in <= length and length > best[0]:
                    best = (length, e)
                for k in range(j + 1, len(runs)):
                    s2, t2, n2 = runs[k]
                    if s2 - (s + n) > 2 * DRIFT:
                        break
                    skip = max(0, s + n - s2, t + n - t2)
                    if skip >= n2:
                        continue
                    gap_s, gap_t = s2 + skip - s - n, t2 + skip - t - n
                    free = FILL * (filled[s2 + skip] - filled[s + n - 1])
                    e2 = e + max(gap_s, gap_t - min(max(0, gap_t - gap_s), free))
                    if e2 <= 2 * self.span // self.one_in and e2 < cost.get(k, 99):
                        cost[k] = e2
        return best

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text the passages found: (number, words reproduced, edits)."""
        hash_words = worker_state("word-hash", WordHash)
        out: list[list[tuple[int, int, int]]] = []
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            words = [WORD.findall(clean(t)) for t in texts[at : at + TEXTS_AT_ONCE]]
            sets = shingles_of(words, hash_words, WIDTH)
            part: list[list[tuple[int, int, int]]] = [[] for _ in words]
            for n, owners in [*self.candidates(sets).items(), *self.counted(sets).items()]:
                codes = sets[n].tolist()
                for owner, domains in owners.items():
                    for lo, hi in domains:
                        if owner not in self.blanked and self.contained(owner, codes[lo:hi]) < self.shared:
                            continue
                        length, edits = self.aligned(owner, words[n][max(0, lo - self.span) : hi + WIDTH + self.span])
                        if length >= self.span:
                            part[n].append((owner, length, edits))
                            break
            out += part
        return out


def leaks(text: Column, index: PassageIndex) -> Column:
    """ARRAY<STRING>: names of the passages that ``text`` reproduces, each once; empty for null text.

    The index goes out with the function; PASSAGES_AT_ONCE bounds its size.
    """
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = index.search([x or "" for x in batch.to_pylist()])
            yield pa.array([sorted({index.names[o] for o, _, _ in f}) for f in found], pa.list_(pa.string()))

    return find(text)


def held_out_passages(seeds: DataFrame, before: str = " Choices:") -> DataFrame:
    """(seed_id, body) of the seeds held out for evaluation: the question before its choices. Null ids and texts are left out."""
    body = F.split(F.col("source_question"), before, 2)[0]
    kept = seeds.filter((F.col("use_for") == "evaluation") & F.col("seed_id").isNotNull() & F.col("source_question").isNotNull())
    return kept.select("seed_id", body.alias("body")).distinct()


def find_leaks(records: DataFrame, passages: DataFrame, span: int = 20, one_in: int = 8, at_once: int = PASSAGES_AT_ONCE) -> DataFrame:
    """(corpus, row_key, seed_id): records that reproduce ``span`` consecutive words of a passage with at most one
    word in ``one_in`` changed, added or dropped.

    ``records`` has corpus, row_key and texts (ARRAY<STRING>, each searched by itself; null elements are
    empty); ``passages`` has seed_id and body. Passages are a stated query set: they are sent to all tasks
    in blocks of ``at_once``, each block a pass over the records. Records are never shuffled. Empty tables
    give an empty result.
    """
    text = records.select("corpus", "row_key", F.array_join(F.coalesce("texts", F.array().cast("array<string>")), BREAK).alias("text"))

    def found_in(block: list[tuple[str, str]]) -> DataFrame:
        return text.select("corpus", "row_key", F.explode(leaks(F.col("text"), PassageIndex(block, span, one_in))).alias("seed_id"))

    done, block = [], []  # one block of passages is on the driver at a time; the rows that earlier ones gave are written
    for row in passages.orderBy("seed_id", "body").toLocalIterator():
        if len(block) >= at_once:
            done.append(cut_lineage(found_in(block)))
            block = []
        block.append((row.seed_id, row.body))
    out = found_in(block)
    for earlier in done:
        out = out.unionByName(earlier)
    return out.distinct() if done else out


#: Joins the texts of a record: words of two texts are never neighbours, since no passage holds these.
BREAK = " \n" + " zzbreakzz" * 12 + " \n "


def corpus_records(items: DataFrame, documents: DataFrame) -> DataFrame:
    """(corpus, row_key, texts) of generated items (stem and passages) and documents (text)."""
    passages = F.coalesce(F.transform("passages", lambda p: p["text"]), F.array().cast("array<string>"))
    own = items.select(F.lit("generated_items").alias("corpus"), F.col("item_ord").alias("row_key"), F.concat(F.array("stem"), passages).alias("texts"))
    return own.unionByName(documents.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("row_key"), F.array("text").alias("texts")))
