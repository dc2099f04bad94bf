"""Token ids in files of bit planes: fixed-size blocks, one zstandard frame per plane, an index of chunks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmlens.llm.running import running_starts
from firmlens.llm.tokens import encoder, text_runs

BLOCK = 16384  # ids of a block; each of its planes is a frame
CHUNK = 65536  # ids after which a chunk ends with the document it is in


def to_planes(ids: np.ndarray, level: int = 3) -> list[bytes]:
    """Bit planes of one block of unsigned 32-bit ids, lowest bit first, up to the highest bit in use, each compressed."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : (width + 7) // 8]
    bits = np.unpackbits(np.ascontiguousarray(octets), axis=1, bitorder="little")[:, :width]
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1)
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The block of ``n`` ids back from its planes."""
    if not planes:
        return np.zeros(n, "<u4")
    press = zstandard.ZstdDecompressor()
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        bits = np.unpackbits(np.frombuffer(press.decompress(plane, max_output_size=(n + 7) // 8), np.uint8), count=n)
        ids |= bits.astype(np.uint32) << np.uint32(k)
    return ids.astype("<u4", copy=False)


def encode_chunk(ids: np.ndarray) -> tuple[list[int], list[int], bytes]:
    """Planes per block, bytes per plane, and all planes behind one another."""
    blocks = [to_planes(ids[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
    return [len(b) for b in blocks], [len(p) for b in blocks for p in b], b"".join(p for b in blocks for p in b)


def decode_chunk(n_ids: int, planes: list[int], sizes: list[int], data: bytes) -> np.ndarray:
    out, at, size = [], 0, iter(sizes)
    for k, width in enumerate(planes):
        found = []
        for _ in range(width):
            n = next(size)
            found.append(data[at : at + n])
            at += n
        out.append(from_planes(found, min(BLOCK, n_ids - k * BLOCK)))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


class IdFiles(NamedTuple):
    """Where the two tables of a written corpus lie."""

    chunks: str  # (part, chunk, doc_ids, lengths, n_ids, planes, plane_bytes, data)
    index: str  # (part, chunk, first, n_ids, n_docs): where each chunk begins among all ids


_CHUNK_FIELDS = "part int, chunk int, doc_ids array<{id}>, lengths array<long>, n_ids long, planes array<int>, plane_bytes array<int>, data binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> IdFiles:
    """Encodes every whole text, appends ``end_id`` and writes all ids in ascending order of the document id.

    Documents are range-partitioned by id (NULL first, equal ids by a hash of their text) and every partition becomes
    a run of chunks. A chunk holds whole documents of at least ``CHUNK`` ids together (the last one of a partition may
    hold fewer) as bit planes of ``BLOCK`` ids. Spark's writer commits the chunk rows, so a lost executor leaves no half
    file. The index is computed from the written chunks. NULL texts are empty; an empty table gives empty files.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    id_type = docs.schema[id_col].dataType
    arrow_id = pa.int64() if id_type.simpleString() == "bigint" else None
    schema = _CHUNK_FIELDS.format(id=id_type.simpleString())
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, chunk = encoder(tokenizer), TaskContext.get().partitionId(), 0
        keys, lengths, held, n_ids = [], [], [], 0

        def row():
            ids = np.frombuffer(b"".join(held), "<u4")
            planes, sizes, data = encode_chunk(ids)
            value = {"part": part, "chunk": chunk, "doc_ids": keys, "lengths": lengths, "n_ids": n_ids, "planes": planes, "plane_bytes": sizes, "data": data}
            kinds = [pa.int32(), pa.int32(), pa.list_(arrow_id) if arrow_id else None, pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(value.values(), kinds)], names=list(value))

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, run in text_runs(batch.column(1)):
                for k, got in enumerate(enc.encode(run)):
                    keys.append(ids[first + k])
                    held.append(got + end)
                    lengths.append(len(held[-1]) // 4)
                    n_ids += lengths[-1]
                    if n_ids >= CHUNK:
                        yield row()
                        keys, lengths, held, n_ids, chunk = [], [], [], 0, chunk + 1
        if keys:
            yield row()

    files = IdFiles(f"{path}/chunks", f"{path}/index")
    tie = F.xxhash64(text_col).alias("_tie")
    ordered = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), tie).repartitionByRange(parts, "_id", "_tie").sortWithinPartitions("_id", "_tie")
    ordered.select("_id", "_text").mapInArrow(chunks, schema).write.option("compression", "none").parquet(files.chunks)
    rows = spark.read.schema(schema).parquet(files.chunks).selectExpr("part", "chunk", "n_ids", "size(doc_ids) AS n_docs")
    begun = running_starts(rows.withColumns({"_part": F.col("part"), "_row": F.col("chunk")}), [], {"first": "n_ids"})
    begun.select("part", "chunk", "first", "n_ids", "n_docs").write.parquet(files.index)
    return files


def read_ids(spark: SparkSession, files: IdFiles, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """Every document from the files: id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (binary, as written).

    Chunks are decoded where they are read; only their place among all ids comes from the index.
    """
    fields = _CHUNK_FIELDS.format(id=id_type)

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                part, chunk, keys, lengths, n_ids, planes, sizes, data = (batch.column(c)[r] for c in range(8))
                ids = decode_chunk(n_ids.as_py(), planes.as_py(), sizes.as_py(), data.as_py()).tobytes()
                lengths = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([chunk.as_py()] * n, pa.int32()), keys.values, pa.array(ends - lengths), pa.array(lengths), pa.array([ids[4 * (e - m) : 4 * e] for e, m in zip(ends.tolist(), lengths.tolist())], pa.binary())],
                    names=["part", "chunk", id_col, "within", "n_tokens", "ids"],
                )

    chunks = spark.read.schema(fields).parquet(files.chunks)
    out = f"part int, chunk int, `{id_col}` {id_type}, within long, n_tokens long, ids binary"
    index = spark.read.schema("part int, chunk int, first long").parquet(files.index)
    docs = chunks.mapInArrow(documents, out)
    return docs.join(index, ["part", "chunk"]).select(id_col, (F.col("first") + F.col("within")).alias("start"), "n_tokens", "ids")
