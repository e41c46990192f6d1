"""Token ids in files: concatenated ids with Elias-Fano coded document boundaries.

A *segment* is one self-contained binary record::

    magic 8 bytes | 8 little-endian int64: id width, documents, null ids, ids, id base, three spare
    ids, 2 bytes each where the vocabulary allows, else 4
    boundaries: the end of each document, Elias-Fano
    doc ids:    ascending, less the base, Elias-Fano

An Elias-Fano sequence of n values below u keeps ``log2(u/n)`` low bits of each value in a packed array
and the rest in unary, about ``2 + log2(u/n)`` bits a value, against 64 for a table of offsets. The place of
every 64th one in the unary part is kept, so ``select`` reads a bounded window.

Segments are rows of a parquet table that Spark commits, so a lost executor leaves no half-written
file and any store Spark can write will do.

Null texts have only the end id; null ids come first; rows that share an id are ordered by their text.
Empty input gives an empty table. Other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm.base import TokenIds, texts
from folio.session import work_path

MAGIC = b"FOLIOEF1"
SAMPLE = 64


class EliasFano:
    """A non-decreasing sequence of whole numbers from 0."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        bits[places] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        a, b = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value."""
        k = i // SAMPLE
        a = int(self.samples[k])
        b = int(self.samples[k + 1]) + 1 if k + 1 < len(self.samples) else len(self.high) * 8
        ones = np.flatnonzero(np.unpackbits(self.high[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 :])
        return ((a + int(ones[i - k * SAMPLE]) - i) << self.low_bits) | int(self._low(i, i + 1)[0])

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.n)

    def pack(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return struct.pack("<5q", self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def unpack(cls, data: memoryview) -> tuple[EliasFano, memoryview]:
        n, low_bits, a, b, c = struct.unpack_from("<5q", data)
        low, high, samples = data[40 : 40 + a], data[40 + a : 40 + a + b], data[40 + a + b : 40 + a + b + c]
        return cls(n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4")), data[40 + a + b + c :]


def pack_segment(doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """Documents in ascending order of id, nulls first; ``ids`` little-endian unsigned 32-bit."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    body = np.frombuffer(b"".join(ids), "<u4")
    ends = np.cumsum([len(x) // 4 for x in ids])
    keys = np.array([d - base for d in known], np.uint64)
    head = MAGIC + struct.pack("<8q", width, len(ids), len(ids) - len(known), len(body), base, 0, 0, 0)
    return b"".join([head, body.astype(f"<u{width}").tobytes(), EliasFano.of(ends).pack(), EliasFano.of(keys).pack()])


class Segment:
    """A segment as read: ``doc(i)`` selects one document, ``bounds`` and ``doc_ids`` all."""

    def __init__(self, blob: bytes):
        data = memoryview(blob)
        if bytes(data[:8]) != MAGIC:
            raise ValueError("not a token segment")
        width, self.n_docs, self.n_null, n_ids, self.base, *_ = struct.unpack_from("<8q", data, 8)
        self.ids = np.frombuffer(data[72 : 72 + n_ids * width], f"<u{width}")
        self.ends, rest = EliasFano.unpack(data[72 + n_ids * width :])
        self.keys, _ = EliasFano.unpack(rest)

    def doc(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]

    def bounds(self) -> np.ndarray:
        return np.concatenate([[0], self.ends.values().astype(np.int64)])

    def doc_ids(self) -> list[int | None]:
        return [None] * self.n_null + [int(k) + self.base for k in self.keys.values()]


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, segment_ids: int = 1 << 21) -> None:
    """Write ``docs`` to the table at ``path`` in ascending ``doc_id`` order.

    Columns: ``part`` and ``seq`` (the order of segments), ``n_docs``, ``n_ids``, ``segment``. A segment
    closes with the document that brings it to ``segment_ids`` ids; documents are never divided.
    """
    keyed = texts(docs).withColumn("_tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encoder, end = None, np.array([end_id], "<u4").tobytes()
        held_ids, held, size = [], [], 0

        def close():
            blob = pack_segment(held_ids, held, width)
            names = ["part", "seq", "n_docs", "n_ids", "segment"]
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(held)], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            if encoder is None:
                encoder = TokenIds.shared(tokenizer)
                width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist())):
                held_ids.append(doc_id)
                held.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= segment_ids:
                    yield close()
                    seq += 1
                    held_ids, held, size = [], [], 0
        if held:
            yield close()

    schema = "part int, seq int, n_docs long, n_ids long, segment binary"
    ordered.mapInArrow(run, schema).write.parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """``part, seq, first_id``: the ids before each segment. Parts are summed first, then segments in a part."""
    sizes = segments.select("part", "seq", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before(Window.orderBy("part"))), F.lit(0)).alias("_base"))
    inside = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("seq"))), F.lit(0))
    return sizes.withColumn("_in", inside).join(parts, "part").select("part", "seq", (F.col("_base") + F.col("_in")).alias("first_id"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files at ``path``."""
    segments = spark.read.parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                s = Segment(blob)
                at = s.bounds()
                crc = [zlib.crc32(s.ids[a:b].astype("<u4").tobytes()) for a, b in zip(at, at[1:])]
                columns = [pa.array(np.full(s.n_docs, part, np.int32)), pa.array(np.full(s.n_docs, seq, np.int32)), pa.array(s.doc_ids(), pa.int64()), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "_at", "n_tokens", "ids_crc32"])

    rows = segments.select("part", "seq", "segment").mapInArrow(run, "part int, seq int, doc_id long, _at long, n_tokens long, ids_crc32 long")
    return rows.join(segment_starts(segments), ["part", "seq"]).select("doc_id", (F.col("first_id") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, path: str | None = None, end_id: int = 1) -> DataFrame:
    """Write the token files (to the shared work folder unless ``path`` is given) and read them back."""
    path = path or work_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer, path, end_id)
    return read_token_files(docs.sparkSession, path)
