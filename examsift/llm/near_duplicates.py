"""Near-duplicate records: DartMinHash signatures, banded joining, exact check.

Shingle hashes are 64 bits. DartMinHash throws darts into the (element, weight, rank) space: the
darts of an element depend on the element alone, a set keeps those below its weights, and every
signature coordinate holds the earliest dart that falls on it. Its cost is about k ln k + set size
instead of k times set size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examsift.operators.sizing import HOT_ROWS, broadcast_if_small, smallest_of_key
from examsift.runtime import cut_lineage, worker_state

WORD = re.compile(r"[^\W_]+")
#: Copies of one text that are paired with each other in one cell of a join; larger classes are split into blocks.
COPIES_IN_BLOCK = 256
#: Texts signed together, and forms whose keys are remembered.
TEXTS_AT_ONCE, KNOWN_FORMS = 32, 4_000
#: Members of a bucket beyond which they are signed again on DEEP_ROWS coordinates a band; what is that large even then is split over SPLIT tasks.
HOT_BUCKET, DEEP_ROWS, SPLIT = 200, 8, 16
#: Buckets of more than two members (16 bytes each) that are broadcast at most.
MANY_BUCKETS = 500_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64) of an array."""
    y = x ^ (x >> np.uint64(30))
    y *= np.uint64(0xBF58476D1CE4E5B9)
    y ^= y >> np.uint64(27)
    y *= np.uint64(0x94D049BB133111EB)
    y ^= y >> np.uint64(31)
    return y


class WordHash:
    """64-bit hashes of words, remembered per worker."""

    def __init__(self, kept: int = 500_000):
        import xxhash

        self.hash, self.kept, self.known = xxhash.xxh3_64_intdigest, kept, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.known) > self.kept:
            self.known.clear()
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in set(words) - known.keys():
                known[w] = self.hash(w)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words (fewer words: none)."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    n = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = mix(out + hashes[k : k + n] + _GOLDEN)
    return out


def shingles_of(texts: list[list[str]], hash_words: WordHash, width: int) -> list[np.ndarray]:
    """``shingles`` of each text, hashed together."""
    every = shingles(hash_words([w for t in texts for w in t]), width)
    ends = np.cumsum([len(t) for t in texts])
    return [every[max(0, end - len(t)) : max(0, end - width + 1)] if len(t) >= width else every[:0] for t, end in zip(texts, ends.tolist())]


class DartMinHash:
    """Signatures of ``k`` coordinates of weighted sets.

    The region of an element is cut into cells of one unit of weight and one of rank; each holds a Poisson(1)
    number of darts that depends on the element and the cell alone. Some k ln k darts fill all coordinates. The
    cost grows with the weight only where a set weighs more than that.
    """

    def __init__(self, k: int, seed: int = 1):
        self.k, self.seed = k, np.uint64(seed)
        shares = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])
        self.limits = [np.uint64(min(2**64 - 1, int(x * 2.0**64))) for x in shares]  # a cell whose hash exceeds the j-th has more than j darts

    def signature(self, elements: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """uint64[k]; equal coordinates of two sets mean the same dart, which has the sets' weighted Jaccard as probability."""
        return self.signatures([elements], None if weights is None else [weights])[0]

    def signatures(self, sets: list[np.ndarray], weights: list[np.ndarray] | None = None) -> np.ndarray:
        """uint64[sets, k], made together; zeros for an empty set."""
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        elements = np.concatenate([*sets, np.empty(0, np.uint64)])
        part = None
        with np.errstate(over="ignore"):
            cells = mix(elements ^ self.seed)
            if weights is not None:
                weight = np.concatenate([*weights, np.empty(0)])
                units = np.ceil(weight).astype(np.int64)
                unit = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
                cells = np.repeat(cells, units) + unit.astype(np.uint64) * _GOLDEN
                part = np.minimum(1.0, np.repeat(weight, units) - unit)  # share of the cell inside the set
                owner = np.repeat(owner, units)
        total = np.bincount(owner, part, len(sets))
        best = np.full((len(sets), self.k), _NONE, np.uint64)
        best[total == 0] = 0
        whole = np.maximum(total, 1e-9)
        first = np.zeros(len(sets), np.int64)
        last = np.ceil(self.k * math.log(self.k + 1) / whole).astype(np.int64)
        more = np.ceil(self.k / whole).astype(np.int64)
        open_ = total > 0
        while open_.any():  # coordinates that are still empty need later darts
            use = open_[owner]
            self._throw(cells[use], None if part is None else part[use], owner[use], first, last, best.reshape(-1))
            open_ &= (best == _NONE).any(axis=1)
            first, last = last, last + more
        return best

    def _throw(self, cells: np.ndarray, part: np.ndarray | None, owner: np.ndarray, first: np.ndarray, last: np.ndarray, best: np.ndarray) -> None:
        """The darts of cells with ranks from ``first`` to before ``last`` of their sets."""
        width = (last - first)[owner]
        at = np.repeat(np.arange(len(cells)), width)
        rank = (np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width) + first[owner][at]).astype(np.uint64)
        with np.errstate(over="ignore"):
            grid = mix(cells[at] + rank * np.uint64(0xD1342543DE82EF95) + _GOLDEN)
            hit = None
            for nth, limit in enumerate(self.limits, 1):
                hit = np.flatnonzero(grid > limit) if hit is None else hit[grid[hit] > limit]
                if not len(hit):
                    break
                dart, thrown = mix(grid[hit] + np.uint64(nth) * _GOLDEN), hit
                if part is not None:
                    inside = (mix(dart + np.uint64(3)) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < part[at[hit]]
                    dart, thrown = dart[inside], hit[inside]
                spot = (dart >> np.uint64(32)) * np.uint64(self.k) >> np.uint64(32)
                # whole rank in the high bits, the dart's own bits below: those within a spot stay random
                np.minimum.at(best, owner[at[thrown]] * self.k + spot.astype(np.int64), ((rank[thrown] + np.uint64(1)) << np.uint64(40)) | (dart >> np.uint64(24)))


def band_plan(threshold: float, rows: int = 4, miss: float = 2e-4) -> int:
    """Bands of ``rows`` coordinates so that a pair at the threshold is missed with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def word_list(text: str | None) -> list[str]:
    """Runs of letters or digits, in lower case; none for null."""
    if not text:
        return []
    return WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in WORD.findall(text)]


def _sets_of(texts: list[list[str]], width: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each list of words."""
    return [np.unique(x) for x in shingles_of(texts, worker_state("word-hash", WordHash), width)]


def _signed(text: Column, width: int, rows: int, bands: int, seed: int = 1) -> Column:
    """STRUCT<form, keys>: 128 bits of the words in order (null without a word), and one key of 44 bits per band (none with
    fewer than ``width`` words)."""
    kind = T.StructType([T.StructField("form", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))])

    @F.arrow_udf(kind)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        darts = DartMinHash(rows * bands, seed)
        lead = mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN)
        known: dict[bytes, np.ndarray] = {}  # forms seen lately: copies are signed once
        for batch in batches:
            forms, keys, ends = [], [], [0]
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                texts = [word_list(t) for t in batch.slice(start, TEXTS_AT_ONCE).to_pylist()]
                own = [xxhash.xxh3_128_digest("\u0001".join(w)) if w else None for w in texts]
                new = {f: w for f, w in zip(own, texts) if f not in known and len(w) >= width}
                if len(known) > KNOWN_FORMS:
                    known.clear()
                    new = {f: w for f, w in zip(own, texts) if len(w) >= width}
                signatures = darts.signatures(_sets_of(list(new.values()), width)).reshape(len(new), bands, rows)
                each = np.repeat(lead[None, :], len(new), axis=0)
                for r in range(rows):
                    each = mix(each + signatures[:, :, r])
                known.update(zip(new, (each >> np.uint64(20)).astype(np.int64)))
                for f in own:
                    found = known.get(f)
                    if found is not None:
                        keys.append(found)
                    ends.append(ends[-1] + (0 if found is None else bands))
                forms += own
            values = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.StructArray.from_arrays([pa.array(forms, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["form", "keys"])

    return sign(text)


def _shingle_set(text: Column, width: int) -> Column:
    """BINARY: the distinct shingle hashes of a text, 64 bits each, in order."""

    @F.arrow_udf(T.BinaryType())
    def collect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                out += [x.tobytes() for x in _sets_of([word_list(t) for t in batch.slice(start, TEXTS_AT_ONCE).to_pylist()], width)]
            yield pa.array(out, pa.binary())

    return collect(text)


def _overlap(left: Column, right: Column) -> Column:
    """STRUCT<common, either>: sizes of the intersection and of the union of two shingle sets, exact."""

    @F.arrow_udf(T.StructType([T.StructField("common", T.LongType()), T.StructField("either", T.LongType())]))
    def compare(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            common, either = [], []
            for x, y in zip(a.to_pylist(), b.to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                common.append(both)
                either.append(len(s) + len(t) - both)
            yield pa.StructArray.from_arrays([pa.array(common, pa.int64()), pa.array(either, pa.int64())], ["common", "either"])

    return compare(left, right)


def _candidates(signed: DataFrame, deeper: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Distinct pairs a < b of (id, keys) that share a key.

    Buckets are counted with their least and greatest id, combined before the shuffle, so a hot bucket costs a row
    per task and most buckets of several members, those of two, are pairs at once. Members of larger ones are
    looked up. Pairs are never made within a bucket of more than HOT_BUCKET members while there is a ``deeper``
    signature: its members are signed again, on more coordinates, and paired by those alone. The last buckets left
    over, of records that agree in many coordinates, are split over tasks.
    """
    keys = signed.select("id", F.explode("keys").alias("key"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n > 1")
    buckets = cut_lineage(buckets)  # keys of one member are most of all and go no further
    pairs = buckets.filter("n = 2").select("a", "b")
    many = buckets.filter("n > 2").select("key", "n")
    most = many.agg(F.max("n")).first()[0] or 0
    if most:
        members = cut_lineage(keys.join(broadcast_if_small(many, MANY_BUCKETS), "key"))
        small, large = members.filter(F.col("n") <= HOT_BUCKET), members.filter(F.col("n") > HOT_BUCKET)
        right = small.select("key", F.col("id").alias("b"))
        pairs = pairs.unionByName(small.select("key", F.col("id").alias("a")).join(right, "key").filter("a < b").select("a", "b"))
        if most > HOT_BUCKET and deeper is not None:
            pairs = pairs.unionByName(_candidates(deeper(large.select("id").distinct())))
        elif most > HOT_BUCKET:
            salt = F.pmod(F.xxhash64("id"), F.lit(SPLIT)).cast("int")
            right = large.select("key", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1))).alias("part"), F.col("id").alias("b"))
            pairs = pairs.unionByName(large.select("key", salt.alias("part"), F.col("id").alias("a")).join(right, ["key", "part"]).filter("a < b").select("a", "b"))
    return pairs.distinct()


def _signed_records(texts: DataFrame, width: int, percent: int, rows: int, miss: float) -> DataFrame:
    """(id, form, keys) of each text, written once."""
    bands = band_plan(percent / 100, rows, miss)
    return cut_lineage(texts.select("id", _signed(F.col("text"), width, rows, bands).alias("_s")).select("id", "_s.form", "_s.keys"))


def _links(texts: DataFrame, signed: DataFrame, width: int, percent: int, miss: float) -> DataFrame:
    """(a, b, common, either) of the ids of ``signed`` whose exact Jaccard reaches ``percent``; texts of candidates alone are read again."""

    def deeper(ids: DataFrame) -> DataFrame:
        again = texts.join(broadcast_if_small(ids), "id", "left_semi")
        return cut_lineage(again.select("id", _signed(F.col("text"), width, DEEP_ROWS, band_plan(percent / 100, DEEP_ROWS, miss), 2).alias("_s")).select("id", "_s.keys"))

    pairs = cut_lineage(_candidates(signed.select("id", "keys"), deeper))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = cut_lineage(texts.join(broadcast_if_small(ids), "id", "left_semi").select("id", _shingle_set(F.col("text"), width).alias("set")))
    left, right = sets.select(F.col("id").alias("a"), F.col("set").alias("_a")), sets.select(F.col("id").alias("b"), F.col("set").alias("_b"))
    checked = pairs.join(left, "a").join(right, "b").select("a", "b", _overlap(F.col("_a"), F.col("_b")).alias("_j"))
    return checked.select("a", "b", "_j.common", "_j.either").filter((F.col("common") > 0) & (F.col("common") * 100 >= F.col("either") * percent))


def _classes(signed: DataFrame, hot_rows: int) -> DataFrame:
    """(id, keep, n_copies): members of classes of several records with the same words in the same order, named by the smallest id."""
    return cut_lineage(smallest_of_key(signed.select("id", "form"), "form", "id", hot_rows).filter("n_copies > 1").select("id", "keep", "n_copies"))


def _linked_classes(texts: DataFrame, width: int, percent: int, rows: int, miss: float, hot_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members of classes of several copies, links between the first records of classes, (id) of all records)."""
    signed = _signed_records(texts, width, percent, rows, miss)
    members = _classes(signed, hot_rows)
    firsts = signed.join(broadcast_if_small(members.filter("id <> keep").select("id")), "id", "left_anti")
    return members, _links(texts, firsts, width, percent, miss).select("a", "b"), signed.select("id")


def _expanded(links: DataFrame, classes: DataFrame, side: str) -> DataFrame:
    """``links`` with each record of the class in place of its name in column ``side``; names of no class stay."""
    sizes = classes.filter("id = keep").select(F.col("keep").alias(side), "blocks")
    cells = links.join(sizes, side, "left").withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    members = classes.select(F.col("keep").alias(side), "block", F.col("id").alias("_id"))
    found = cells.join(members, [side, "block"], "left").withColumn(side, F.coalesce("_id", F.when(F.col("blocks").isNull(), F.col(side))))
    return found.filter(F.col(side).isNotNull()).select("a", "b")  # a block may be empty


def similar_records(texts: DataFrame, width: int = 5, percent: int = 80, rows: int = 4, miss: float = 2e-4, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b), a < b: all pairs of records whose Jaccard of distinct word runs is at least ``percent`` / 100, copies included.

    ``texts`` has id and text, ids distinct. DartMinHash band keys select the pairs, an exact count on both texts decides. A
    pair at the threshold is missed with probability ``miss``, others with less. Null and empty texts are in no pair; texts of
    fewer than ``width`` words only with copies of theirs.
    Records with the same words are first collapsed to classes and only one text per class is
    compared. Classes are written out as all their pairs, and a link between two classes as all
    pairs across; large classes in blocks, so that no task holds one. ``similar_groups`` gives the same
    result without writing pairs out.
    """
    members, links, _ = _linked_classes(texts, width, percent, rows, miss, hot_rows)
    blocks = F.ceil(F.col("n_copies") / COPIES_IN_BLOCK).cast("int")
    cells = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    one = cells.select("keep", F.col("id").alias("a"), F.col("block").alias("i"), F.explode(every).alias("j"))
    two = cells.select("keep", F.col("id").alias("b"), F.explode(every).alias("i"), F.col("block").alias("j"))
    inside = one.join(two, ["keep", "i", "j"]).filter("a < b").select("a", "b")
    both = _expanded(_expanded(links, cells, "a"), cells, "b")
    return inside.unionByName(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(id, group): the connected parts of (a, b), each named by its smallest id.

    Every id points to a smaller one of its part. A round lets each id follow its own and its neighbours' pointers,
    then its pointer's pointer, so chains shorten by half. The tables are narrow; a round takes three shuffles and
    their number grows with the logarithm of the longest chain.
    """
    edges = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    points = cut_lineage(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("to")))
    while True:
        at_b = points.select(F.col("id").alias("b"), F.col("to").alias("_to"))
        near = edges.join(at_b, "b").groupBy(F.col("a").alias("id")).agg(F.min("_to").alias("_near"))
        new = points.join(near, "id").select("id", "to", F.least("to", "_near").alias("_new"))
        jump = new.select(F.col("id").alias("_new"), F.col("_new").alias("_next"))
        after = cut_lineage(new.join(jump, "_new").select("id", "to", F.least("_new", "_next").alias("_new")))
        if after.filter("to <> _new").isEmpty():
            return after.select("id", F.col("to").alias("group"))
        points = after.select("id", F.col("_new").alias("to"))


def similar_groups(texts: DataFrame, width: int = 5, percent: int = 80, rows: int = 4, miss: float = 2e-4, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, class, group, links): one row per record.

    ``class`` is the smallest id with the same words, ``group`` the smallest id of all that are linked directly or over
    others, ``links`` the number of records at or above the threshold. Copies are counted, not paired.
    """
    members, links, ids = _linked_classes(texts, width, percent, rows, miss, hot_rows)
    links = cut_lineage(links)
    sizes = members.filter("id = keep").select(F.col("id").alias("b"), "n_copies")
    both = links.select("a", "b").union(links.select("b", "a")).join(sizes, "b", "left")
    across = both.groupBy(F.col("a").alias("keep")).agg(F.sum(F.coalesce("n_copies", F.lit(1))).alias("_across"))
    named = ids.join(members, "id", "left").withColumns({"keep": F.coalesce("keep", "id"), "n_copies": F.coalesce("n_copies", F.lit(1))})
    out = named.join(across, "keep", "left").join(components(links).withColumnRenamed("id", "keep"), "keep", "left")
    return out.select("id", F.col("keep").alias("class"), F.coalesce("group", "keep").alias("group"), (F.col("n_copies") - 1 + F.coalesce("_across", F.lit(0))).alias("links"))


def item_texts(items: DataFrame) -> DataFrame:
    """(id, text): item_ord with stem, stimulus and explanation joined by spaces, null as empty. Repeated rows of an item_ord count once."""
    parts = [F.coalesce(c, F.lit("")) for c in ("stem", "stimulus", "explanation")]
    own = items.filter("item_ord is not null")
    if not own.groupBy("item_ord").count().filter("count > 1").isEmpty():  # texts are only moved if need be
        own = own.dropDuplicates(["item_ord"])
    return own.select(F.col("item_ord").alias("id"), F.concat_ws(" ", *parts).alias("text"))


def similar_items(items: DataFrame, width: int = 3, percent: int = 60) -> DataFrame:
    """(item_a, item_b) of near-duplicate items."""
    return similar_records(item_texts(items), width, percent).select(F.col("a").alias("item_a"), F.col("b").alias("item_b"))


def item_groups(items: DataFrame, width: int = 3, percent: int = 60) -> DataFrame:
    """(item_ord, class, group, links) of all items."""
    return similar_groups(item_texts(items), width, percent).withColumnRenamed("id", "item_ord")
