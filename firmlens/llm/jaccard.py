"""Exact Jaccard join of word n-gram sets by T-occurrence search, and the components of its links."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmlens.llm.components import components
from firmlens.session import stored

ROUNDS = (1.3, 3.0)  # hash ranges, as multiples of the share a set may have alone, in which sets without a partner drop out
LOOK_BACK = 3  # last sets with the same smallest or largest hash that a set is compared with before the search
HUBS = 6  # and first ones, which have the fewest members alone and are near the middle of their group
LIST_SETS = 512  # sets whose inverted lists are held together
SKIP = 16  # of this many required occurrences one more must be in the short lists
BROADCAST_ROWS = 1 << 20  # ids and digests (24 bytes each) up to this number are broadcast, more are joined by shuffle
_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``n``-grams; with fewer words, of the whole sequence; none without words."""
    words = (text or "").encode("utf-8").lower().split()  # on bytes: A-Z and the six white space bytes only
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed = mixed * _P + h[k : len(words) - size + 1 + k]
    mixed ^= mixed >> np.uint64(33)
    mixed *= np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def digest(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _border(share: float) -> int:
    """The hash below which that share of all hashes lies, in signed order."""
    return min(2**63 - 1, int(share * 2**64) - 2**63)


def _slack(n: Column, percent: int) -> Column:
    """How many of a set's members a partner may lack."""
    return F.floor(n * (100 - percent) / 100)


def _sets(docs: DataFrame, n: int, id_col: str) -> DataFrame:
    """(id, n, digest, key) per row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, n) for t in batch.column(1).to_pylist()]
            marks = [digest(s) for s in found]
            keys = [int.from_bytes(m[:8], "little", signed=True) for m in marks]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.int64())], names=["id", "n", "digest", "key"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), "text").mapInArrow(run, f"id {kind}, n long, digest binary, key long")


def _text_postings(docs: DataFrame, n: int, end: float) -> DataFrame:
    """(hash, key) of the hashes below ``end`` of every text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i in range(0, len(texts), 500):
                found = [shingle_hashes(t, n) for t in texts[i : i + 500]]
                keys = [int.from_bytes(digest(s)[:8], "little", signed=True) for s in found]
                part = [s[s < _border(end)] for s in found]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)), pa.array(np.repeat(np.array(keys, np.int64), [len(p) for p in part]))], names=["hash", "key"])

    return docs.select("text").mapInArrow(run, "hash long, key long")


def _alone(postings: DataFrame) -> DataFrame:
    """(key, alone): how many hashes no other set has. Equal sets have equal keys and count as one."""
    owners = postings.groupBy("hash").agg(F.min("key").alias("key"), F.max("key").alias("_other"))
    return owners.where("key = _other").groupBy("key").agg(F.count("*").alias("alone"))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _with_hashes(docs: DataFrame, wanted: DataFrame, n: int, id_col: str) -> DataFrame:
    """``wanted`` (digest, sid, n, id, alone) with ``hashes``, from the documents with these ids, once per set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t, n) for t in batch.column(0).to_pylist()]
            ends = np.cumsum([0] + [len(s) for s in found])
            hashes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([digest(s) for s in found], pa.binary()), hashes], names=["digest", "hashes"])

    count = wanted.count()
    ids = wanted.select(F.col("id").alias("_id")).distinct()
    # Only id and text take part: the documents' other columns may have any names.
    texts = docs.select(F.col(id_col).alias("_key"), "text")
    picked = texts.join(_small(ids, count), F.col("_key").eqNullSafe(F.col("_id")), "left_semi").select("text")
    made = picked.mapInArrow(run, "digest binary, hashes array<long>").join(_small(wanted, count), "digest")
    sets = stored(made.select("sid", "n", "alone", "hashes"), "hashes")
    # Ids that occur in several rows brought some texts twice.
    return sets if sets.select("sid").distinct().count() == sets.count() else stored(sets.dropDuplicates(["sid"]), "hashes")


def enough(overlap: int, a: int, b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (a + b - overlap)


def overlap_of(short: np.ndarray, long: np.ndarray) -> int:
    """How many members of the first sorted array a binary search finds in the second."""
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    return int((long[at] == short).sum()) if len(long) else 0


def _first_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links found cheaply: sets with their smallest or largest hash in common, each compared with a few before it.

    Sets with few members alone come first: what is nearest to all other near copies of a text is compared with all of them.
    These links only spare the search the inside of large groups; links that are missed here are found there.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, hubs, before = None, [], deque(maxlen=LOOK_BACK)
        for batch in batches:
            a, b = [], []
            for where, sid, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = hashes.values.to_numpy(zero_copy_only=False)
                if where != place:
                    place, hubs = where, []
                    before.clear()
                for other, theirs in [*hubs, *before]:
                    if enough(overlap_of(own, theirs), len(own), len(theirs), percent):
                        a.append(sid)
                        b.append(other)
                if len(hubs) < HUBS:
                    hubs.append((sid, own))
                else:
                    before.append((sid, own))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    ends = F.array_distinct(F.array(F.array_min("hashes"), F.array_max("hashes")))
    placed = sets.select(F.explode(ends).alias("place"), "sid", "hashes", "n", "alone")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = placed.repartitionByRange(parts, "place", "alone", "n", "sid").sortWithinPartitions("place", "alone", "n", "sid")
    return ordered.select("place", "sid", "hashes").mapInArrow(run, "a long, b long")


class _Lists:
    """The inverted short lists of one block of sets."""

    def __init__(self, held: list[tuple[list, np.ndarray, np.ndarray]]):
        # Members are in the order of their ids, so every list is sorted.
        self.sid, self.s, self.c, self.n, self.wanted, self.long, _, self.high = (np.array(x, np.int64) for x in zip(*(row for row, _, _ in held)))
        self.whole = [whole for _, _, whole in held]
        hashes = np.concatenate([short for _, short, _ in held])
        owners = np.repeat(np.arange(len(held)), [len(short) for _, short, _ in held])
        order = np.lexsort((owners, hashes))
        self.owners = owners[order]
        self.hashes, self.starts = np.unique(hashes[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(order))

    def partners(self, row: list, short: np.ndarray, whole: np.ndarray, percent: int) -> list[int]:
        """Sets of smaller rank that occur in enough of the short lists and, by probing, have enough in common."""
        _, s, c, n, wanted, long, low, high = row
        fits = ((self.s < s) | ((self.s == s) & (self.c < c))) & (self.n >= low) & (self.n <= high) & (self.high >= n)
        at = np.searchsorted(self.hashes, short)
        at[at == len(self.hashes)] = 0
        lists = [self.owners[self.starts[k] : self.ends[k]] for k in at[self.hashes[at] == short]]
        member, times = merge_lists([m[fits[m]] for m in lists])
        size = self.n[member]
        most = np.minimum(np.minimum(times + np.maximum(long, self.long[member]), n), size)
        keep = (times >= np.minimum(wanted, self.wanted[member])) & (100 * most >= percent * (n + size - most))
        return [int(self.sid[m]) for m in member[keep] if enough(overlap_of(whole, self.whole[m]), n, int(self.n[m]), percent)]


def merge_lists(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Members of sorted lists with the number of lists that hold them.

    The stable sort finds the lists as runs in order and merges them, which is what a heap of list heads does one by one.
    """
    merged = np.sort(np.concatenate([np.zeros(0, np.int64), *lists]), kind="stable")
    starts = np.flatnonzero(np.append(True, merged[1:] != merged[:-1])) if len(merged) else np.zeros(0, np.int64)
    return merged[starts], np.diff(np.append(starts, len(merged)))


def _searched_links(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets in different groups that are linked: T-occurrence search over inverted lists.

    The lists of a set are ordered by length, then hash. A partner occurs in T of them; with L long ones put aside it
    still occurs in T - L of the short ones, and as the order is the same for all sets, these are short for the partner
    too, so only short lists are inverted. They are merged, and for what occurs often enough in them the long ones are
    probed by binary search in its set. Of two groups, the smaller one searches, so that a list of one large group is not met by its own
    members. Sets are dealt into blocks; a task holds the lists of one block and is sent, one after the other, the
    sets that search any of them. Sets whose sizes cannot fit do not search.
    """
    blocks = max(1, math.ceil(sets.count() / LIST_SETS))
    postings = sets.select("sid", F.explode("hashes").alias("hash"))
    lengths = postings.groupBy("hash").count().where("count > 1")
    lists = postings.join(lengths, "hash").groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("count", "hash"))).alias("lists"))
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    wanted = (1 + F.floor(F.greatest(F.lit(0), least - 1) / SKIP)).cast("int")
    own = sets.select("sid", "n").join(groups.select("sid", F.struct((-F.col("members")).alias("s"), F.col("component").alias("c")).alias("place")), "sid")
    shared = F.size("lists")
    searched = lists.join(own, "sid").where(shared >= least).select(
        "sid", "n", "place", wanted.alias("wanted"), (least - wanted).alias("long"), least.alias("low"),
        # A partner that has all it can in common must still not be too large.
        (F.floor(shared * (100 + percent) / percent) - F.col("n")).alias("high"),
        F.slice(F.transform("lists", lambda x: x["hash"]), F.lit(1), shared - least + wanted).alias("short"),
    )
    searched = stored(searched, "searched")
    listed = searched.select("sid", "n", "place", "wanted", "long", "low", "high", F.explode("short").alias("hash"))
    bounds = listed.groupBy("hash").agg(F.min("n").alias("_least"), F.max("n").alias("_most"), F.count("*").alias("_count")).where("_count > 1")
    listed = stored(listed.join(bounds, "hash").where("low <= _most AND high >= _least").drop("_least", "_most", "_count"), "listed")
    mixed = listed.groupBy("hash").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first != last").select("hash", "first")
    mixed = stored(mixed, "mixed")
    fields = [F.col("sid"), F.col("place.s").alias("s"), F.col("place.c").alias("c"), *map(F.col, ("n", "wanted", "long", "low", "high", "short", "hashes"))]
    whole = sets.select("sid", "hashes")
    block = F.pmod(F.xxhash64("sid"), F.lit(blocks))
    index = searched.join(listed.join(mixed, "hash").select("sid").distinct(), "sid", "left_semi")
    index = index.join(whole, "sid").select(block.alias("block"), F.lit(0).alias("asks"), *fields)
    asked = listed.join(mixed, "hash").where("place > first").select("hash", "sid")
    places = listed.join(mixed.select("hash"), "hash", "left_semi").select("hash", block.alias("block")).distinct()
    visits = asked.join(places, "hash").select("sid", "block").distinct()
    asking = visits.join(searched, "sid").join(whole, "sid").select("block", F.lit(1).alias("asks"), *fields)
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = index.unionByName(asking).repartition(parts, "block").sortWithinPartitions("block", "asks", "sid")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, lists = None, [], None
        for batch in batches:
            a, b = [], []
            for i, (at, asks, *row) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:10]))):
                short, hashes = (batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in (10, 11))
                if at != current:
                    current, held, lists = at, [], None
                if not asks:
                    held.append((row, short, hashes))
                    continue
                lists = lists or _Lists(held)
                found = lists.partners(row, short, hashes, percent)
                a += [row[0]] * len(found)
                b += found
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the smallest id that links reach, its own included).

    A document's set are its distinct word ``n``-grams; two documents are linked if 100 * intersection >= percent * union.
    Words are runs without ASCII white space, A-Z in lower case. A document with fewer words has one member, one without
    words (or with a NULL text) has none and is linked with nothing. All links count and none is lost:

    1. Equal sets become one (a 128-bit digest), however many copies there are.
    2. A set may have only a share of its members alone if it has any partner. Members of a growing range of hashes
       are counted, and sets that have too many alone drop out; most of a corpus goes here, before any list is built.
    3. Of what is left, sets with their smallest or largest hash in common are compared with a few others, so that
       large groups of near copies are tied together without their pairs.
    4. Between groups, links are found by T-occurrence search over inverted lists.
    5. Links are closed to components by alternating stars.

    Members are 64-bit hashes. NULL ids are documents of their own kind and take the smallest id of their component.
    An empty table gives no rows; other columns are ignored.
    """
    rows = stored(_sets(docs, n, id_col), "sets")
    distinct = rows.where("n > 0").groupBy("digest", "key", "n").agg(F.min("id").alias("id"))
    distinct = stored(distinct.withColumn("sid", F.monotonically_increasing_id()), "distinct")
    share = (100 - percent) / 100
    ends = [min(1.0, r * share) for r in ROUNDS]
    alone = _alone(_text_postings(docs, n, ends[0]))
    left = distinct.join(alone, "key", "left").where(F.coalesce("alone", F.lit(0)) <= _slack(F.col("n"), percent))
    left = stored(left.select("digest", "sid", "n", "id", F.coalesce("alone", F.lit(0)).alias("alone")), "left")
    sets = _with_hashes(docs, left, n, id_col)
    part = F.filter("hashes", lambda h: (h >= _border(ends[0])) & (h < _border(ends[1])))
    more = _alone(sets.select(F.col("sid").alias("key"), F.explode(part).alias("hash"))).select(F.col("key").alias("sid"), F.col("alone").alias("more"))
    kept = sets.join(more, "sid", "left").where(F.col("alone") + F.coalesce("more", F.lit(0)) <= _slack(F.col("n"), percent))
    sets = stored(kept.select("sid", "n", "hashes", (F.col("alone") + F.coalesce("more", F.lit(0))).alias("alone")), "sets")

    first = stored(_first_links(sets, percent).distinct(), "first")
    tied = components(first)
    groups = sets.select("sid").join(tied.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("component", "sid").alias("component"))
    groups = stored(groups, "groups")
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    links = stored(first.unionByName(_searched_links(sets, groups.join(sizes, "component"), percent)), "links")

    final = components(links).withColumnRenamed("node", "sid")
    placed = stored(distinct.select("digest", "id", "sid").join(final, "sid", "left").select("digest", "id", F.coalesce("component", "sid").alias("component")), "placed")
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    named = placed.join(least, "component").select("digest", "component_id")
    return rows.join(named, "digest", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
