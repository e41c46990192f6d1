"""What the operators share: reading tables, words, token ids, Arrow batches."""

from __future__ import annotations

import ctypes
import os
import re
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHARED: dict[str, object] = {}


def shared(name: str, make: Callable[[], object]):
    """What all tasks of a worker process use under ``name``; it displaces what other operators left there."""
    if name not in _SHARED:
        _SHARED.clear()
        _SHARED[name] = make()
    return _SHARED[name]


def trim() -> None:
    """Give memory that is free inside this worker process back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def forget() -> None:
    """Free what earlier tasks left in this worker process."""
    _SHARED.clear()
    trim()


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, in a process that holds nothing of earlier tasks and keeps nothing of this one."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        yield from run(batches)
        trim()

    return whole


def portions(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows at most, for steps that hold several times a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as the empty one; any further column is left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def in_fold(doc_id: str, parts: int, rest: int):
    """Whether crc32 of the id as text leaves ``rest`` modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts == rest


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function that is made once per task and returns the columns of each batch.

    A batch without rows is not handed on, and columns come back in the order of ``schema``.
    """
    from pyspark.sql.types import StructType

    names = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        forget()
        for batch in batches:
            if batch.num_rows:
                step = step or make()
                columns = step(batch)
                if columns is not None and len(columns[names[0]]):
                    yield pa.RecordBatch.from_arrays([pa.array(columns[n]) if not isinstance(columns[n], pa.Array) else columns[n] for n in names], names)
        step = None
        trim()

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a batch end to end, and where each text starts (one more than texts)."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def words_of(text: str) -> list[bytes]:
    """Words divided by blanks and the control characters 9 to 13, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


# How the tokenizer divides plain text in lower case (a fixed value of its file): words, digits, endings, signs.
_PIECE = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u012f]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~\u00d7\u00f7]+")
# Letters of whose case and composition the library and Python surely think alike, and all else in ASCII.
_ODD = re.compile(r"[^\t\n\r\x20-\x7e\u00c0-\u012f]|<\|")
_UNEVEN = re.compile(_ODD.pattern + r"|[!-/:-@\[-`{-~\u00d7\u00f7]{2}")

# The same of ASCII texts by bytes: a for what is neither a sign nor odd, a full stop for signs, 0 for odd characters.
_KINDS = bytes(ord(".") if _PIECE.fullmatch(chr(c)) and not chr(c).isalnum() else 0 if _ODD.match(chr(c)) else ord("a") for c in range(256))


def _even(text: str) -> bool:
    """Whether a text holds no odd character and no two signs that stand together."""
    if not text.isascii():
        return not _UNEVEN.search(text)
    kinds = text.encode().translate(_KINDS)
    return b".." not in kinds and b"\0" not in kinds


class TokenIds:
    """Ids of a text with the tokenizers library, remembered for each piece of it.

    The tokenizer works on words, single digits and runs of signs by themselves, so a plain text's ids are its
    pieces' ids end to end; new words go to the library many at a time. Blank-separated words with
    unusual characters are pieces of their own, under a leading zero character. When ``room`` pieces are
    known they become the older half of the memory, from which those still in use come back. Values are
    little-endian unsigned 32-bit ids.
    """

    def __init__(self, path: str, room: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For words of letters in lower case, which need no folding and no division but at blanks.
        self.by_word = Tokenizer.from_file(path)
        self.by_word.normalizer = normalizers.Sequence([])
        self.by_word.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.room, self.known, self.older = room, {}, {}

    @classmethod
    def shared(cls, path: str) -> TokenIds:
        """One memory for all tasks of a worker process."""
        return shared(f"ids {path}", lambda: cls(path))

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.tokenizer.encode_batch(words, add_special_tokens=False)]

    def _learn(self, fresh: set[str]) -> None:
        if len(self.known) > self.room:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        known.update((p, older[p]) for p in fresh if p in older)
        words = [p for p in fresh if p not in older and p.isalpha()]
        for at in range(0, len(words), 500):
            part = words[at : at + 500]
            found = self.by_word.encode(" ".join(part), add_special_tokens=False)
            owner = np.array(found.word_ids, np.int64)
            edges = np.searchsorted(owner, np.arange(len(part) + 1)) * 4
            body = np.array(found.ids, "<u4").tobytes()
            if len(owner) and owner[-1] == len(part) - 1 and (np.diff(edges) > 0).all():
                known.update((w, body[a:b]) for w, a, b in zip(part, edges[:-1].tolist(), edges[1:].tolist()))
            else:
                known.update(zip(part, self._whole(part)))
        other = [p for p in fresh if p not in older and not p.isalpha()]
        known.update(zip(other, self._whole([p.removeprefix("\0") for p in other])))

    @staticmethod
    def _pieces(text: str) -> list[str]:
        if _even(text):  # no two signs stand together, so each full stop and comma is by itself
            return text.lower().replace(".", " .").replace(",", " ,").split()
        if not _ODD.search(text):
            return _PIECE.findall(text.lower())
        out = []
        for word in text.replace("\n", " ").split(" "):
            if _ODD.search(word):
                out.append("\0" + word)
            else:
                out += _PIECE.findall(word.lower())
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 64):
            held, fresh = [], set()
            for text in texts[at : at + 64]:
                pieces = self._pieces(text)
                ids = list(map(self.known.get, pieces))
                new, k = [], -1
                with suppress(ValueError):  # until no place is left
                    while True:
                        k = ids.index(None, k + 1)
                        new.append((k, pieces[k]))
                fresh.update(p for _, p in new)
                held.append((ids, new))
            if fresh:
                self._learn(fresh)
            for ids, new in held:
                for k, piece in new:
                    ids[k] = self.known[piece]
                yield b"".join(ids)
