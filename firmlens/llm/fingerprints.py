"""Document fingerprints: content-defined chunks of a normalised gear hash, digest sets weighted by length."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.session import stored

WINDOW = 32  # bytes that a 32-bit gear hash depends on
LEAST, NORMAL, MOST = 32, 64, 256  # bytes of a chunk; LEAST >= WINDOW keeps hashes independent of where a text begins
HARD = np.uint32(0xFE000000)  # 7 bits below the normal size, 5 above: sizes gather around it
EASY = np.uint32(0xF8000000)
RUN_BYTES = 2 << 20  # bytes of text that a worker hashes at a time
BUCKETS = 4  # runs of neighbouring ids per shuffle partition
GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=4).digest() for b in range(256)), "<u4")

Chunks = dict[int, int]  # digest -> bytes


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the last 32 bytes' table values, each shifted by its age, summed by doubling."""
    h, reach = GEAR[data], 1
    while reach < WINDOW:
        older = np.zeros_like(h)
        older[reach:] = h[:-reach] << np.uint32(reach)
        h, reach = h + older, 2 * reach
    return h


def chunk_texts(texts: list[bytes]) -> list[Chunks]:
    """The chunk set of each text. Hashes are taken over all texts at once; a chunk never reaches into another text."""
    whole = b"".join(texts)
    h = gear(np.frombuffer(whole, np.uint8)) if whole else np.zeros(0, np.uint32)
    easy = np.flatnonzero((h & EASY) == 0)
    hard = easy[(h[easy] & HARD) == 0].tolist()
    easy = easy.tolist()
    out, begin = [], 0
    for text in texts:
        found, at, end = {}, begin, begin + len(text)
        while at < end:
            cut = min(at + MOST, end)
            i = bisect_left(hard, at + LEAST - 1)
            if i < len(hard) and hard[i] < min(at + NORMAL - 1, end):
                cut = hard[i] + 1
            else:
                i = bisect_left(easy, at + NORMAL - 1)
                if i < len(easy) and easy[i] < cut:
                    cut = easy[i] + 1
            found[xxhash.xxh3_64_intdigest(whole[at:cut]) >> 8] = cut - at
            at = cut
        out.append(found)
        begin = end
    return out


def containment(a: Chunks, b: Chunks) -> float:
    """Share of the bytes of ``a``'s chunks that ``b`` has too; two empty sets contain each other, an empty and another do not."""
    total = sum(a.values())
    return sum(n for d, n in a.items() if d in b) / total if total else float(not b)


def likeness(a: Chunks, b: Chunks) -> float:
    """The smaller of both containments."""
    return min(containment(a, b), containment(b, a))


def written(chunks: Chunks) -> str:
    """Digests with their lengths, in the order of digests."""
    return " ".join(f"{d:014x}.{n:x}" for d, n in sorted(chunks.items()))


def parsed(fingerprint: str) -> Chunks:
    return {int(d, 16): int(n, 16) for d, n in (x.split(".") for x in fingerprint.split())}


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, gives way to as many of ``following`` (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, borrowed, id, text), partitioned by bucket and in descending order of id within it.

    Buckets are ranges of ids. The first document of a bucket is also lent to the bucket before it (the very first to the
    last one), so that every document has the next one at hand after one shuffle of the texts, which travel compressed.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    shares = [i / (BUCKETS * parts) for i in range(1, BUCKETS * parts)]
    cuts = sorted(set(docs.agg(F.percentile_approx(order, shares, 100 * BUCKETS * parts)).first()[0] or []))

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(np.array(cuts, np.int64), ids.to_numpy(np.int64), side="left"))

    @F.pandas_udf("binary")
    def pressed(texts: pd.Series) -> pd.Series:
        press = zstandard.ZstdCompressor(level=1)
        return texts.map(lambda t: press.compress((t or "").encode("utf-8")))

    heads = docs.select(order.alias("_order")).withColumn("_bucket", bucket("_order")).groupBy("_bucket").agg(F.max("_order").alias("_head"))
    heads = stored(heads, "heads")
    ring = Window.orderBy("_bucket")  # one row per bucket, a fixed number per shuffle partition
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lent = F.coalesce(F.lag("_bucket").over(ring), F.last("_bucket").over(everything))
    lent = F.broadcast(heads.select(F.col("_head").alias("_order"), lent.alias("_lent")))
    rows = docs.select(F.col(id_col).alias("_id"), order.alias("_order"), F.xxhash64(text_col).alias("_tie"), pressed(F.col(text_col)).alias("_text"))
    rows = rows.withColumn("_bucket", bucket("_order")).join(lent, "_order", "left")
    own = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("borrowed"))
    borrowed = F.struct(F.col("_lent").alias("b"), F.lit(True).alias("borrowed"))
    places = F.when(F.col("_lent").isNull(), F.array(own)).otherwise(F.array(own, borrowed))
    rows = rows.withColumn("_place", F.explode(places)).select(F.col("_place.b").alias("_bucket"), F.col("_place.borrowed").alias("_borrowed"), "_order", "_tie", "_id", "_text")
    return rows.repartition(parts, "_bucket").sortWithinPartitions("_bucket", "_borrowed", F.desc("_order"), "_tie").select("_bucket", "_borrowed", "_id", "_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The next document is the one with the next smaller id, after the last the first; NULL ids come last, equal ids are in
    the order of a hash of their text. The likeness of two fingerprints is the smaller share of either's chunk bytes
    that the other has. Equal texts have equal fingerprints, NULL texts count as empty, an empty text has an empty
    fingerprint and a likeness of 1 to another empty one. An only document follows itself; an empty table gives no rows.
    Rows of one id stay in one bucket.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def compare(keys: list, texts: list[str], follower: str) -> pa.RecordBatch:
        changed = [edited(t, n).encode("utf-8") for t, n in zip(texts, [*texts[1:], follower])]
        own = chunk_texts([t.encode("utf-8") for t in [*texts, follower]])
        new = chunk_texts(changed)
        columns = [
            pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array([written(c) for c in own[:-1]]), pa.array([written(c) for c in new]),
            pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        current, keys, texts, size = None, [], [], 0
        for batch in batches:
            for bucket, borrowed, key, data in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3)):
                if borrowed and bucket != current:
                    continue  # only the first borrowed document is the next of the bucket's last one
                text = press.decompress(data.as_py()).decode("utf-8")
                if borrowed:
                    yield compare(keys, texts, text)
                    current, keys, texts, size = None, [], [], 0
                    continue
                if size >= RUN_BYTES:
                    yield compare(keys, texts, text)
                    keys, texts, size = [], [], 0
                current = bucket
                keys.append(key)
                texts.append(text)
                size += len(data.as_py())

    return _neighbours(docs, id_col, text_col).mapInArrow(run, schema)
