"""Benchmark decontamination by latent semantic retrieval.

The benchmark is taken in blocks of ``BLOCK_ITEMS`` items. For a block, each text's words are numbered and
written once as numbers; then:

1. Spark counts in how many passages (``WINDOW`` words) of all documents each benchmark word occurs; words in more
   than ``STOP_SHARE`` of them are stop words.
2. Tasks add up ``A'A R`` for the TF-IDF matrix A of all passages, its words the block's, and random R; from the
   sum the driver gets the leading right singular vectors (Nystrom form of the randomised SVD). The
   sum has one row for each word of the block, whatever the corpus.
3. Overlapping passages of all documents are projected and compared with the projected items by cosine: that is how an
   item is found. Only *thin* items, which ``THIN`` active words or fewer may be all that is left of, have no
   direction of their own in a passage; passages with these words around them are candidates whatever their cosine, and
   items that can be held without any active word are looked for by all their words.
   For each candidate around which enough of the item's words lie, in any order, the longest common
   subsequence of words is found bit-parallel. A
   document holds an item when the subsequence covers ``COVER`` of it, and half of its answer (the words of
   its last sentence) or ``SURE`` of all of it; items below ``SHORT`` words must be covered whole.

Null and empty texts hold nothing, and items without words are found nowhere. Repeated rows are each
reported; an empty table gives an empty result. ``clean`` keeps all columns of its input.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import forget, portions, texts, tidied
from folio.session import materialize, scratch

BLOCK_ITEMS = 256
WINDOW, STRIDE = 64, 32
STOP_SHARE = 0.02
COSINE = 0.2
THIN = 3
COVER, SURE, SHORT = 0.6, 0.8, 8
_OUTER = string.punctuation + "«»„“”‘’‚…–—¿¡·"
_OUTER_SET = frozenset(_OUTER)
_SLICES = 64


def normal(word: str) -> str:
    """A word without case and outer punctuation."""
    return word.lower().strip(_OUTER)


def word_ids(words: dict[str, int], text: str) -> np.ndarray:
    """Number of each blank-separated word of a text among the block's words, -1 for others."""
    raw = text.lower().split()
    ids = list(map(words.get, raw, repeat(-1)))
    for k, word in [(k, word) for k, word in enumerate(raw) if not word.isalnum()]:
        if word[-1] in _OUTER_SET or word[0] in _OUTER_SET:
            ids[k] = words.get(word.strip(_OUTER), -1)
    return np.array(ids, np.int32)


@dataclass
class Block:
    """One block of items: their words as numbers, and the answer's words."""

    item_ids: list[int]
    words: dict[str, int]
    items: list[list[int]]
    answers: list[list[int]]

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Block:
        words: dict[str, int] = {}
        ids, items, answers = [], [], []
        for item_id, text in rows:
            raw = [w for w in (text or "").split() if normal(w)]
            if not raw:
                continue
            numbers = [words.setdefault(normal(w), len(words)) for w in raw]
            ends = [k + 1 for k, w in enumerate(raw[:-1]) if w[-1] in ".?!:"]
            ids.append(item_id)
            items.append(numbers)
            answers.append(numbers[ends[-1] :] if ends else numbers)
        return cls(ids, words, items, answers)


def blocks(benchmark: DataFrame, size: int = BLOCK_ITEMS) -> Iterator[Block]:
    """The benchmark's items in blocks of about ``size``, by a hash of id and text; each is read by itself."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    n = -(-rows.count() // size)
    for k in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text")
        block = Block.of([(r.item_id, r.text) for r in part.toLocalIterator()])
        if block.items:
            yield block


def numbered(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id, ids``: the word numbers of each text that holds any, written once for the passes that follow."""
    words = block.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            held = [ids.tobytes() if (ids := word_ids(words, x.as_py())).size else b"" for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.binary())], ["doc_id", "ids"])

    return materialize(texts(docs).mapInArrow(run, "doc_id long, ids binary"), "numbered_words")


def _tokens(numbers: Iterable[np.ndarray], active: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, all word numbers, and the places and numbers of words that are active, for texts that have any."""
    known = np.append(active, False)  # also for the number -1
    for k, ids in enumerate(numbers):
        places = np.flatnonzero(known[ids])
        if len(places):
            yield k, ids, places, ids[places]


def _stored(batch: pa.RecordBatch, at: int) -> Iterator[np.ndarray]:
    """Word numbers of each row from the column that ``numbered`` wrote."""
    return (np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(at))


def _groups(batch: pa.RecordBatch, active: np.ndarray, size: int = 50) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places and numbers of active words of ``size`` texts end to end, each from a passage of its own on; and the passages."""
    held, passages = [], 0
    for _, ids, places, terms in _tokens(_stored(batch, 0), active):
        held.append((places + passages * WINDOW, terms))
        passages += -(-len(ids) // WINDOW)
        if len(held) == size:
            yield *(np.concatenate(x) for x in zip(*held)), passages
            held, passages = [], 0
    if held:
        yield *(np.concatenate(x) for x in zip(*held)), passages


def _sum_rows(parts: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Sum of tables that come as rows ``slice, terms, body``: per slice, word numbers and their float vectors."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        terms = np.concatenate([np.frombuffer(x, np.int32) for x in frame["terms"]])
        body = np.concatenate([np.frombuffer(x, np.float32).reshape(-1, width) for x in frame["body"]])
        distinct, place = np.unique(terms, return_inverse=True)
        total = np.zeros((len(distinct), width))
        np.add.at(total, place.ravel(), body)
        return pd.DataFrame({"slice": [int(frame["slice"].iloc[0])], "terms": [distinct.astype(np.int32).tobytes()], "body": [total.astype(np.float32).tobytes()]})

    schema = "slice int, terms binary, body binary"
    out = {}
    for row in parts.groupBy("slice").applyInPandas(add, schema).toLocalIterator():
        out.update(zip(np.frombuffer(row.terms, np.int32).tolist(), np.frombuffer(row.body, np.float32).reshape(-1, width)))
    return out


def _emit(table: np.ndarray) -> pa.RecordBatch:
    """The rows of ``table`` that are not zero, by slice of the word number."""
    used = np.flatnonzero(table.any(1)).astype(np.int32)
    rows = [(s, t) for s in range(_SLICES) if len(t := used[used % _SLICES == s])]
    columns = [pa.array([s for s, _ in rows], pa.int32()), pa.array([t.tobytes() for _, t in rows], pa.binary()), pa.array([table[t].astype(np.float32).tobytes() for _, t in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["slice", "terms", "body"])


def passage_counts(ids: DataFrame, block: Block) -> tuple[np.ndarray, float]:
    """Passages in which each word occurs, and the number of passages, over all documents as ``numbered`` gives them."""
    n = len(block.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, everything = np.zeros(n + 1), np.ones(n, bool)
        for batch in batches:
            for places, terms, passages in _groups(batch, everything):
                pairs = np.sort(places // WINDOW * n + terms)
                first = np.concatenate([[True], pairs[1:] != pairs[:-1]])
                counts[:n] += np.bincount(pairs[first] % n, minlength=n)
                counts[n] += passages
        yield _emit(counts[:, None])

    # Counts travel as float32 parts of at most one task's passages and are summed in double precision.
    found = _sum_rows(ids.select("ids").mapInArrow(run, "slice int, terms binary, body binary"), 1)
    out = np.zeros(n + 1)
    for term, value in found.items():
        out[term] = value[0]
    return out[:n], float(out[n])


def _row_sums(table: np.ndarray, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the table's ``rows`` from each place in ``first`` to the next, for short runs: the k-th of all runs at once."""
    size = np.diff(np.append(first, len(rows)))
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    total = table[rows[first]]
    for k in range(1, int(size.max(initial=0))):
        longer = np.searchsorted(-size, -k)
        total[:longer] += table[rows[first[:longer] + k]]
    out = np.empty_like(total)
    out[order] = total
    return out


def _windows(words: np.ndarray) -> np.ndarray:
    """How many windows texts of so many words have."""
    return np.maximum(1, -(-(words - WINDOW + STRIDE) // STRIDE))


def _window_rows(places: np.ndarray, words: int, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that hold an active word, and the range of active words of each."""
    starts = np.arange(0, max(1, words - size + stride), stride)
    low, high = np.searchsorted(places, starts), np.searchsorted(places, starts + size)
    some = high - low > 0
    return starts[some], low[some], high[some]


def latent_space(ids: DataFrame, block: Block, idf: np.ndarray, seed: int = 5) -> np.ndarray:
    """Leading right singular vectors of the passages' TF-IDF matrix, one row for each word, scaled by idf."""
    n, width = len(idf), min(len(idf), len(block.items) + 32)
    active = idf > 0

    def noise() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((n, width)).astype(np.float32)

    def add(total: np.ndarray, weighted: np.ndarray, places: np.ndarray, terms: np.ndarray) -> None:
        window = places // WINDOW
        new = np.concatenate([[True], window[1:] != window[:-1]])
        size = np.diff(np.append(np.flatnonzero(new), len(terms)))
        several = np.repeat(size > 1, size)  # a single word says nothing about which go together
        if not several.any():
            return
        terms, first, size = terms[several], np.flatnonzero(new[several]), size[size > 1]
        weight = idf[terms].astype(np.float32)
        y = _row_sums(weighted, terms, first) / np.add.reduceat(weight**2, first)[:, None]
        order = np.argsort(terms, kind="stable")
        owner, terms = np.repeat(np.arange(len(size)), size)[order], terms[order]
        starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        total[terms[starts]] += np.add.reduceat(y[owner], starts, axis=0) * idf[terms[starts], None].astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, width), np.float32)
        weighted = noise() * idf[:, None].astype(np.float32)
        for batch in batches:
            for places, terms, _ in _groups(batch, active):
                add(total, weighted, places, terms)
        yield _emit(total)

    found = _sum_rows(ids.select("ids").mapInArrow(run, "slice int, terms binary, body binary"), width)
    omega = noise().astype(float)
    z = np.zeros((n, width))
    for term, row in found.items():
        z[term] = row
    for item in block.items:  # the items are passages too
        terms = np.array([t for t in item if active[t]], np.int64)
        if len(terms):
            a = np.bincount(terms, idf[terms], n)
            a /= np.linalg.norm(a)
            z += np.outer(a, a @ omega)
    shift = 1e-6 * (np.linalg.norm(z) + 1e-12)
    z += shift * omega
    inner = omega.T @ z
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    good = values > 1e-9 * max(values.max(), 1e-12)
    factor = z @ (vectors[:, good] / np.sqrt(values[good]))
    u, _, _ = np.linalg.svd(factor, full_matrices=False)
    return (u * idf[:, None]).astype(np.float32)


def common_subsequence(item: list[int], ids: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit for each word of the item."""
    masks: dict[int, int] = {}
    for k, t in enumerate(item):
        masks[t] = masks.get(t, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for t in ids.tolist():
        m = masks.get(t)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(item) - row.bit_count()


class LeakFinder:
    """Finds the items of a block in texts given as word numbers."""

    def __init__(self, block: Block, idf: np.ndarray, space: np.ndarray):
        self.block, self.space, self.active = block, space, idf > 0
        vectors, owner = [], []
        for k, item in enumerate(block.items):
            for at in range(0, max(1, len(item)), WINDOW):
                terms = [t for t in item[at : at + WINDOW] if self.active[t]]
                vectors.append(space[terms].sum(0) if terms else np.zeros(space.shape[1], np.float32))
                owner.append(k)
        self.owner = np.array(owner)
        q = np.array(vectors, np.float32)
        self.sizes = np.array([len(x) for x in block.items])
        distinct = [sorted(set(x)) for x in block.items]
        # Place of a word among an item's distinct words, with -1 for words not in it, also for the number -1.
        self.place = np.full((len(block.items), len(idf) + 1), -1, np.int32)
        self.often = np.zeros((len(block.items), max(map(len, distinct))), np.int32)
        for k, (item, own) in enumerate(zip(block.items, distinct)):
            self.place[k, own] = np.arange(len(own))
            np.add.at(self.often[k], self.place[k, item], 1)
        self.queries = (q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)).T.copy()
        # The least words of an item that a text holding it shares with it, and the least active words among these.
        self.cover = np.where(self.sizes < SHORT, self.sizes, np.ceil(COVER * self.sizes - 1e-9)).astype(np.int64)
        self.need = self.cover - np.array([sum(not self.active[t] for t in item) for item in block.items])
        # Weak items can be held without any active word; they are looked for by all their words.
        self.weak, self.strong = np.flatnonzero(self.need <= 0), np.flatnonzero(self.need > 0)
        # Thin items can be held by so few active words that what stands around them decides the cosine.
        self.thin = self.strong[self.need[self.strong] <= THIN]
        self.shared = (self.place[self.thin, :-1].T >= 0) & self.active[:, None]
        self.by_cosine = np.flatnonzero(self.need[self.owner] > THIN)

    def by_words(self, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, window start and thin item wherever the active words leave a long enough subsequence possible, whatever the cosine."""
        size = np.array([len(ids) for _, ids, _, _ in held])
        own = np.array([len(terms) for *_, terms in held])
        there = self.shared[np.concatenate([terms for *_, terms in held])]
        often = np.add.reduceat(there, np.cumsum(own) - own, axis=0, dtype=np.int64)
        row, thin = np.nonzero(often >= self.need[self.thin])
        pair = np.full(often.shape, -1)
        pair[row, thin] = np.arange(len(row))
        # The places of each pair's words, one pair after the other, a span of numbers each.
        word, q = np.nonzero(there)
        of = pair[np.repeat(np.arange(len(held)), own)[word], q]
        span = int(size.max()) + WINDOW + int(self.sizes.max()) + 1
        places = np.sort((of * span + np.concatenate([places for _, _, places, _ in held])[word])[of >= 0])
        windows = _windows(size)[row]
        of = np.repeat(np.arange(len(row)), windows)
        starts = (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
        items = self.thin[thin][of]
        first = np.searchsorted(places, of * span + np.maximum(starts - self.sizes[items], 0))
        near = np.searchsorted(places, of * span + starts + WINDOW + self.sizes[items]) - first >= self.need[items]
        return row[of][near], starts[near], items[near]

    def cosine(self, item: int, ids: np.ndarray) -> float:
        """Highest cosine of a text's windows with an item, 0 without active words."""
        best = 0.0
        for _, _, places, terms in _tokens([ids], self.active):
            _, low, high = _window_rows(places, len(ids), WINDOW, STRIDE)
            sums = np.zeros((len(terms) + 1, self.space.shape[1]), np.float32)
            np.cumsum(self.space[terms], axis=0, out=sums[1:])
            v = sums[high] - sums[low]
            near = v @ self.queries[:, self.owner == item] / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
            best = max(best, float(near.max()))
        return best

    def candidates(self, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, window start, item and cosine of near windows, for texts as ``_tokens`` gives them; thin and weak items are left out.

        A window is two strides, so words are summed up by stride; each text has one stride more than windows.
        """
        strides = _windows(np.array([len(ids) for _, ids, _, _ in held])) + 1
        first = np.cumsum(strides) - strides
        stride = np.concatenate([places // STRIDE + at for (_, _, places, _), at in zip(held, first)])
        new = np.flatnonzero(np.concatenate([[True], stride[1:] != stride[:-1]]))
        sums = np.zeros((int(strides.sum()), self.space.shape[1]), np.float32)
        sums[stride[new]] = _row_sums(self.space, np.concatenate([terms for *_, terms in held]), new)
        some = np.zeros(len(sums), bool)
        some[stride[new]] = True
        some[:-1] |= some[1:]
        some[first + strides - 1] = False
        window = np.flatnonzero(some)
        v = sums[window] + sums[window + 1]
        size = np.maximum(np.linalg.norm(v, axis=1), 1e-12)
        cosine = v @ self.queries[:, self.by_cosine]
        w, q = np.nonzero(cosine >= (COSINE * size)[:, None])
        rows = np.repeat(np.arange(len(held)), strides)[window]
        return rows[w], ((window - first[rows]) * STRIDE)[w], self.owner[self.by_cosine[q]], cosine[w, q] / size[w]

    def bounds(self, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], rows: np.ndarray, starts: np.ndarray, items: np.ndarray, cells: int = 1 << 19) -> np.ndarray:
        """No common subsequence around the windows is longer: the words of each item that lie there, as often as in it."""
        texts_ = [ids for _, ids, _, _ in held]
        body = np.concatenate([*texts_, np.full(1, -1, np.int32)])
        edge = np.concatenate([[0], np.cumsum([len(x) for x in texts_])])
        low = edge[rows] + np.maximum(starts - self.sizes[items], 0)
        size = np.minimum(edge[rows] + starts + WINDOW + self.sizes[items], edge[rows + 1]) - low
        out = np.zeros(len(rows), np.int64)
        width = self.often.shape[1]
        step = max(1, cells // max(width, int(size.max(initial=1))))
        for at in range(0, len(rows), step):
            part = slice(at, at + step)
            owner = np.repeat(np.arange(len(rows[part])), size[part])
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(size[part]) - size[part], size[part])
            place = self.place[items[part][owner], body[low[part][owner] + inner]]
            found = place >= 0
            seen = np.bincount(owner[found] * width + place[found], minlength=len(rows[part]) * width).reshape(-1, width)
            out[part] = np.minimum(seen, self.often[items[part]]).sum(1)
        return out

    def enough(self, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], rows: np.ndarray, starts: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Whether as many active words of the item lie around each window as holding it takes, repeats counted."""
        edge = np.concatenate([[0], np.cumsum([len(ids) for _, ids, _, _ in held])])
        places = np.concatenate([places + e for (_, _, places, _), e in zip(held, edge)])
        terms = np.concatenate([terms for *_, terms in held])
        first = np.searchsorted(places, edge[rows] + np.maximum(starts - self.sizes[items], 0))
        size = np.searchsorted(places, np.minimum(edge[rows] + starts + WINDOW + self.sizes[items], edge[rows + 1])) - first
        owner = np.repeat(np.arange(len(rows)), size)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        found = self.place[items[owner], terms[first[owner] + inner]] >= 0
        return np.bincount(owner[found], minlength=len(rows)) >= self.need[items]

    def check(self, item: int, ids: np.ndarray, starts: list[int]) -> tuple[int, int]:
        """Best common subsequence around the windows, and the answer's part in that place; a place that holds the item goes first."""
        words, answer = self.block.items[item], self.block.answers[item]
        best, done = (0, 0), -1
        for start in sorted(set(starts)):
            a, b = max(0, start - len(words)), start + WINDOW + len(words)
            if a < done and start + WINDOW <= done - len(words):
                continue
            done = b
            near = ids[a:b]
            near = near[self.place[item, near] >= 0]
            if len(near) < COVER * len(words):
                continue
            n = common_subsequence(words, near)
            if n < COVER * len(words) and n <= best[0]:
                continue
            found = (n, common_subsequence(answer, near))
            best = max(best, found, key=lambda x: (self.holds(item, *x), x[0]))
        return best

    def holds(self, item: int, n: int, answered: int) -> bool:
        size, answer = len(self.block.items[item]), len(self.block.answers[item])
        if size < SHORT:
            return n == size
        return n >= COVER * size and (2 * answered >= answer or n >= SURE * size)

    def find(self, texts_: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], chunk: int = 2_000) -> list[tuple[int, int, int, float]]:
        """(row, item, length of the common subsequence, cosine) of every item held."""
        out, held, size = [], [], 0

        def settle():
            near = self.candidates(held)[:3]
            likely = self.enough(held, *near)
            out.extend(self.settled(held, *(np.concatenate([x[likely], y]) for x, y in zip(near, self.by_words(held)))))

        for row in texts_:
            held.append(row)
            size += len(row[2])
            if size >= chunk:
                settle()
                held, size = [], 0
        if held:
            settle()
        return out

    def settled(self, held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], rows: np.ndarray, starts: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """The items held around the given windows."""
        long = self.bounds(held, rows, starts, items) >= COVER * self.sizes[items]
        near: dict[tuple[int, int], list[int]] = {}
        for k, item, start in zip(rows[long].tolist(), items[long].tolist(), starts[long].tolist()):
            near.setdefault((k, item), []).append(start)
        for (k, item), found in near.items():
            n, answered = self.check(item, held[k][1], found)
            if self.holds(item, n, answered):
                yield held[k][0], item, n, self.cosine(item, held[k][1])

    def find_weak(self, texts_: list[tuple[int, np.ndarray]], chunk: int = 64) -> Iterator[tuple[int, int, int, float]]:
        """The same for weak items, by all their words: counted by strides first, then around each window that is left."""
        for at in range(0, len(texts_), chunk):
            held = [(k, ids, ids, ids) for k, ids in texts_[at : at + chunk]]
            sizes = np.array([len(ids) for _, ids, _, _ in held])
            strides = -(-sizes // STRIDE)
            first = np.cumsum(strides) - strides
            body = np.concatenate([ids for _, ids, _, _ in held])
            stride = np.repeat(first, sizes) + (np.arange(len(body)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // STRIDE
            windows = _windows(sizes)
            rows = np.repeat(np.arange(len(held)), windows)
            starts = (np.arange(len(rows)) - np.repeat(np.cumsum(windows) - windows, windows)) * STRIDE
            for item in self.weak.tolist():
                size, width = self.sizes[item], int(np.count_nonzero(self.often[item]))
                place = self.place[item, body]
                found = np.flatnonzero(place >= 0)
                seen = np.zeros((int(strides.sum()) + 1, width), np.int32)
                np.cumsum(np.bincount(stride[found] * width + place[found], minlength=(len(seen) - 1) * width).reshape(-1, width), axis=0, out=seen[1:])
                low = first[rows] + np.maximum(starts - size, 0) // STRIDE
                high = first[rows] + np.minimum(-(-(starts + WINDOW + size) // STRIDE), strides[rows])
                near = np.minimum(seen[high] - seen[low], self.often[item, :width]).sum(1) >= self.cover[item]
                if near.any():
                    yield from self.settled(held, rows[near], starts[near], np.full(int(near.sum()), item))


def _finder(ids: DataFrame, block: Block) -> tuple[np.ndarray, np.ndarray]:
    counts, passages = passage_counts(ids, block)
    idf = np.where(counts <= max(STOP_SHARE * passages, 3), np.log((passages + 1) / (counts + 0.5)), 0.0)
    idf = np.maximum(idf, 0)
    return idf, latent_space(ids, block, idf)


def _search(block: Block, idf: np.ndarray, space: np.ndarray, numbers: list[np.ndarray], state: dict) -> list[tuple[int, int, int, float]]:
    if not state:
        state["finder"] = LeakFinder(block, idf, space)
    finder = state["finder"]
    found = finder.find(_tokens(numbers, finder.active))
    if len(finder.weak):
        found += finder.find_weak([(k, ids) for k, ids in enumerate(numbers) if (ids >= 0).any()])
    return found


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, common, item_words, cosine``: every item that a document holds."""
    spark, schema = docs.sparkSession, "doc_id long, item_id long, common long, item_words long, cosine double"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark):
        numbers = numbered(docs, block)
        sent = spark.sparkContext.broadcast((block, *_finder(numbers, block)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            state: dict = {}
            block_, idf, space = sent.value
            for batch in batches:
                ids = batch.column(0)
                found = _search(block_, idf, space, list(_stored(batch, 1)), state)
                columns = [
                    pa.array([ids[k].as_py() for k, *_ in found], pa.int64()),
                    pa.array([block_.item_ids[i] for _, i, _, _ in found], pa.int64()),
                    pa.array([n for _, _, n, _ in found], pa.int64()),
                    pa.array([len(block_.items[i]) for _, i, _, _ in found], pa.int64()),
                    pa.array([c for *_, c in found], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "common", "item_words", "cosine"])

        out = out.union(numbers.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    at = docs.columns.index("text")
    rows, with_id = docs, docs.select(F.lit(0).alias("doc_id"), "text")
    for block in blocks(benchmark):
        with scratch(docs.sparkSession):
            found = _finder(numbered(with_id, block), block)
        sent = docs.sparkSession.sparkContext.broadcast((block, *found))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            state: dict = {}
            for batch in portions(batches):
                numbers = [word_ids(sent.value[0].words, x.as_py() or "") for x in batch.column(at)]
                held = {k for k, *_ in _search(*sent.value, numbers, state)}
                yield batch.filter(pa.array([k not in held for k in range(batch.num_rows)], pa.bool_())) if held else batch

        rows = rows.mapInArrow(tidied(run), docs.schema)
    return rows
