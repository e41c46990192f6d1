"""Repeated phrases removed by suffix automata of reference shards.

A *window* is ``length`` words; one that also starts elsewhere is removed. Its *anchor* is its least ``gram``-word
hash, the leftmost on a tie: equal windows have equal anchors, so a window whose anchor is met once cannot
repeat. That leaves the reference:

1. Each text is cut into runs of windows with a common anchor. Texts of the same words are one class, which counts as
   often as it has copies; anchors met once over all classes are dropped.
2. The words of a run are its *context*. Every place of a window lies in one context, and all places of equal windows
   in contexts of one anchor. Equal contexts are one row with a count.
3. Contexts are dealt to reference shards by their anchor. A task builds a shard's suffix automaton, in which each state
   knows how often its strings occur, and streams the shard's contexts through it: the matching statistic at a word is the
   longest string that ends there and occurs twice in the reference. Statistics of ``length`` or more are
   the maximal spans to remove. Words are compared as such, not by hashes.
4. Spans go back to the places of their context, and from there to all rows of the class.

All automata together are larger than the repeated text, so no task and not the driver could hold them: each shard's
automaton is shared by all documents that have one of its anchors, in the task that has built it. An anchor with more than
``MANY`` contexts would make a shard too large; its contexts are cut into single windows, dealt by their hashes.

Null and empty texts have no words and lose none, nor do texts of fewer than ``length`` words. Rows that repeat are
copies of each other and lose all words when long enough. An empty table gives an empty result; columns other
than ``doc_id`` and ``text`` are ignored. Classes and contexts are told apart by cryptographic digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, texts
from folio.llm.suffix import Polynomial
from folio.operators.spread import spread_join
from folio.session import materialize, scratch

LENGTH, GRAM = 35, 12
SHARD_WORDS = 50_000
MANY = 1000
_SHARDS_A_TASK = 8
_NONE = np.zeros(0, np.int64)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Phrases:
    """The words of a text, and its runs of windows with a common anchor."""

    def __init__(self, text: str, length: int, gram: int, poly: Polynomial):
        self.body = b" ".join(text.encode().split())
        data = np.frombuffer(self.body, np.uint8)
        blanks = np.flatnonzero(data == 32)
        self.start = np.concatenate([[0], blanks + 1]) if len(data) else _NONE
        self.end = np.concatenate([blanks, [len(data)]]) if len(data) else _NONE
        self.length = length
        n = len(self.start)
        self.anchors, self.first, self.last = np.zeros(0, np.uint64), _NONE, _NONE
        if n >= length:
            prefix = poly.prefix(data)
            grams = n - gram + 1
            begin = self.start[:grams]
            h = (prefix[self.end[gram - 1 :]] - prefix[begin]) * poly.inv[begin]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            at = _least_places(h, length - gram + 1)
            self.first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            self.last = np.concatenate([self.first[1:], [len(at)]]) - 1
            self.anchors = h[at[self.first]]

    def context(self, run: int) -> bytes:
        return self.body[self.start[self.first[run]] : self.end[self.last[run] + self.length - 1]]

    def without(self, gone: np.ndarray) -> bytes:
        """The words that are not ``gone``, joined by blanks."""
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (~gone).astype(np.int8), [0]])))
        return b" ".join(self.body[self.start[a] : self.end[b - 1]] for a, b in zip(edges[::2], edges[1::2]))


def _least_places(h: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` neighbours is, the leftmost on a tie."""
    keys = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(h) // width) * width, np.uint64(2**64 - 1))
    padded[: len(h)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Automaton:
    """Suffix automaton of several sequences; ``count`` tells how often the strings of a state occur in them."""

    def __init__(self) -> None:
        self.ahead: list[dict[int, int]] = [{}]
        self.link, self.size, self.count = [-1], [0], [0]

    def add(self, sequence: list[int], times: int) -> None:
        ahead, link, size, count = self.ahead, self.link, self.size, self.count
        last = 0
        for c in sequence:
            old = ahead[last].get(c)
            if old is not None and size[old] == size[last] + 1:
                last = old
            elif old is not None:
                last = self._split(last, c, old)
            else:
                new = len(ahead)
                ahead.append({})
                size.append(size[last] + 1)
                link.append(0)
                count.append(0)
                p = last
                while p >= 0 and c not in ahead[p]:
                    ahead[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = ahead[p][c]
                    link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
                last = new
            count[last] += times

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the shorter strings of ``q``, those that end with a string of ``p`` and ``c``."""
        ahead, link, size = self.ahead, self.link, self.size
        new = len(ahead)
        ahead.append(ahead[q].copy())
        size.append(size[p] + 1)
        link.append(link[q])
        self.count.append(0)
        link[q] = new
        while p >= 0 and ahead[p].get(c) == q:
            ahead[p][c] = new
            p = link[p]
        return new

    def finish(self) -> None:
        """Counts go from longer strings to their ends; the empty string is everywhere."""
        size, link, count = self.size, self.link, self.count
        for v in sorted(range(1, len(size)), key=size.__getitem__, reverse=True):
            count[link[v]] += count[v]
        count[0] = 1 << 62

    def statistics(self, sequence: list[int], times: int = 2) -> list[int]:
        """At each place the length of the longest string that ends there and occurs ``times`` or more often."""
        ahead, link, size, count = self.ahead, self.link, self.size, self.count
        v, n, out = 0, 0, []
        for c in sequence:
            to = ahead[v].get(c)
            while to is None and v:
                v = link[v]
                n = size[v]
                to = ahead[v].get(c)
            if to is not None:
                v, n = to, n + 1
                while count[v] < times:
                    v = link[v]
                    n = size[v]
            out.append(n)
        return out


def _anchored(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``doc_id, mark, n_words, sha, grams``: the text's class and its anchors, twice where met more often."""

    def make():
        poly = Polynomial()

        def step(batch: pa.RecordBatch) -> dict:
            n, sha, ends, values = [], [], [0], []
            for text in batch.column(2):
                phrases = Phrases(text.as_py(), length, gram, poly)
                n.append(len(phrases.start))
                sha.append(hashlib.sha256(phrases.body).digest())
                h, times = np.unique(phrases.anchors, return_counts=True)
                h = np.concatenate([h, h[times > 1]]).view(np.int64)
                values.append(h)
                ends.append(ends[-1] + len(h))
            grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values)))
            return {"doc_id": batch.column(0), "mark": batch.column(1), "n_words": pa.array(n, pa.int64()), "sha": pa.array(sha, pa.binary()), "grams": grams}

        return step

    return arrow_map(_marked(docs), make, "doc_id long, mark long, n_words long, sha binary, grams array<long>")


def _marked(docs: DataFrame) -> DataFrame:
    return texts(docs).select("doc_id", F.xxhash64("text").alias("mark"), "text")


def _places(wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """``class, gram, context, at, n, words, body``: each run with a repeated anchor; a task gives a body when it first meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly, met = Polynomial(), set()
        for batch in batches:
            for k, (own, copies, text) in enumerate(zip(*(batch.column(i).to_pylist() for i in range(3)))):
                phrases = Phrases(text, length, gram, poly)
                hits = np.flatnonzero(np.isin(phrases.anchors.view(np.int64), batch.column(3)[k].values.to_numpy(zero_copy_only=False)))
                if not len(hits):
                    continue
                contexts, bodies = [], []
                for at in hits.tolist():
                    body = phrases.context(at)
                    key = _digest(body)
                    contexts.append(key)
                    bodies.append(None if key in met else body)
                    if len(met) > 500_000:
                        met.clear()
                    met.add(key)
                columns = [
                    pa.array([own] * len(hits), pa.binary()),
                    pa.array(phrases.anchors[hits].view(np.int64)),
                    pa.array(contexts, pa.binary()),
                    pa.array(phrases.first[hits].astype(np.int32)),
                    pa.array([copies] * len(hits), pa.int64()),
                    pa.array((phrases.last[hits] - phrases.first[hits] + length).astype(np.int64)),
                    pa.array(bodies, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["class", "gram", "context", "at", "n", "words", "body"])

    schema = "class binary, gram long, context binary, at int, n long, words long, body binary"
    return wanted.select("sha", "copies", "text", "grams").mapInArrow(run, schema)


def _single_windows(contexts: DataFrame, length: int) -> DataFrame:
    """``context, at, window, n, body``: the windows of each context by themselves."""

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"context": [], "at": [], "window": [], "n": [], "body": []}
            for context, n, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = body.split(b" ")
                for at in range(len(words) - length + 1):
                    window = b" ".join(words[at : at + length])
                    for name, value in zip(out, (context, at, _digest(window), n, window)):
                        out[name].append(value)
            kinds = (pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
            return {name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)}

        return step

    return arrow_map(contexts.select("context", "n", "body"), make, "context binary, at int, window binary, n long, body binary")


def match(contexts: DataFrame, length: int, shards: int) -> DataFrame:
    """``context, spans``: first and last repeated windows of contexts ``key, context, n, body``.

    Contexts with the same ``key`` are in the same shard.
    """

    def solve(held: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        sequences = [[numbers.setdefault(w, len(numbers)) for w in body.split(b" ")] for _, _, body in held]
        automaton = Automaton()
        for sequence, (_, n, _) in zip(sequences, held):
            automaton.add(sequence, n)
        automaton.finish()
        keys, spans = [], []
        for sequence, (key, _, _) in zip(sequences, held):
            found = np.array(automaton.statistics(sequence), np.int64)[length - 1 :] >= length
            edges = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
            if len(edges):
                edges[1::2] -= 1
                keys.append(key)
                spans.append(edges.astype(np.int32))
        ends = np.cumsum([0, *map(len, spans)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(spans) if spans else np.zeros(0, np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), lists], ["context", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = [], None
        for batch in batches:
            for own, *row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if own != shard and held:
                    yield solve(held)
                    held = []
                shard = own
                held.append(tuple(row))
        if held:
            yield solve(held)

    dealt = contexts.select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "context", "n", "body")
    tasks = max(-(-shards // _SHARDS_A_TASK), contexts.sparkSession.sparkContext.defaultParallelism)
    return dealt.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(run, "context binary, spans array<int>")


def _cut(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``class, n_removed, kept_sha256`` from ``class, text, pieces``."""

    def make():
        poly = Polynomial()

        def step(batch: pa.RecordBatch) -> dict:
            pieces = batch.column(2)
            at, spans = pieces.flatten().flatten()
            sizes = pc.list_value_length(spans).to_numpy()
            places = spans.flatten().to_numpy() + np.repeat(at.to_numpy(), sizes)
            begin, end = places[::2], places[1::2] + length
            ends = np.concatenate([[0], np.cumsum(sizes // 2)])[np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy())])]
            removed, sha = [], []
            for k, text in enumerate(batch.column(1)):
                phrases = Phrases(text.as_py(), 1 << 62, gram, poly)
                n, own = len(phrases.start) + 1, slice(ends[k], ends[k + 1])
                gone = np.cumsum(np.bincount(begin[own], minlength=n) - np.bincount(end[own], minlength=n))[:-1] > 0
                removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(phrases.without(gone)).hexdigest())
            return {"class": batch.column(0), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": sha}

        return step

    return arrow_map(rows.select("class", "text", "pieces"), make, "class binary, n_removed long, kept_sha256 string")


def _with_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the text of their leader, each once; texts travel to the rows at every size."""
    named = rows.select("*", F.col("leader.doc_id").alias("_id"), F.col("leader.mark").alias("_mark")).drop("leader")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return _marked(docs).hint("merge").join(named, same).drop("doc_id", "mark", "_id", "_mark")


def remove_phrases(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, many: int = MANY, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``."""
    c = F.col
    spark = docs.sparkSession
    with scratch(spark) as keep:
        with scratch(spark) as keep_pieces:
            anchored = materialize(_anchored(docs, length, gram), "anchored")
            rows = keep_pieces(anchored.select("doc_id", "n_words", c("sha").alias("class")), "rows")
            leader = F.struct("doc_id", "mark")
            classes = anchored.groupBy("sha").agg(F.min(leader).alias("leader"), F.count("*").alias("copies"), F.min_by("grams", leader).alias("grams"))
            classes = materialize(classes.filter(F.size("grams") > 0), "classes")
            with scratch(spark) as keep_contexts:
                with scratch(spark) as keep_places:
                    met = materialize(classes.select("sha", F.explode("grams").alias("gram"), "copies"), "met")
                    often = met.groupBy("gram").agg(F.sum("copies").alias("_n")).filter("_n > 1").select("gram")
                    repeated = spread_join(met, often, ["gram"], "left_semi").groupBy("sha").agg(F.collect_set("gram").alias("grams"))
                    wanted = materialize(classes.drop("grams").join(repeated, "sha"), "wanted")
                    places = keep_places(_places(_with_text(docs, wanted).dropDuplicates(["sha"]), length, gram), "places")
                contexts = places.groupBy("context", "gram").agg(F.sum("n").alias("n"), F.max("words").alias("words"), F.max("body").alias("body"))
                contexts = keep_contexts(contexts, "contexts")
                where = keep_contexts(places.select("class", "context", "at"), "where")
            with scratch(spark) as keep_spans:
                crowded = materialize(contexts.groupBy("gram").agg(F.count("*").alias("_n")).filter(c("_n") > many).select("gram"), "crowded")
                single = materialize(_single_windows(spread_join(contexts, crowded, ["gram"], "left_semi"), length), "single")
                windows = single.groupBy("window").agg(F.sum("n").alias("n"), F.max("body").alias("body"))
                windows = windows.select(c("window").alias("key"), c("window").alias("context"), "n", "body")
                others = spread_join(contexts, crowded, ["gram"], "left_anti")
                others = others.select(c("gram").cast("string").cast("binary").alias("key"), "context", "n", "body")
                words = contexts.agg(F.sum("words")).first()[0] or 0
                found = materialize(match(others.union(windows), length, words // shard_words + 1), "found")
                hits = single.join(found.select(c("context").alias("window")), "window", "left_semi")
                spans = keep_spans(found.union(hits.groupBy("context").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("spans"))), "spans")
            pieces = spread_join(where, spans, ["context"]).groupBy("class").agg(F.collect_list(F.struct("at", "spans")).alias("pieces"))
            pieces = keep_pieces(pieces.join(classes.select(c("sha").alias("class"), "leader"), "class"), "pieces")
        cut = _cut(_with_text(docs, pieces).dropDuplicates(["class"]), length, gram)
        cut = materialize(cut, "cut")
        out = spread_join(rows, cut, ["class"], "left")
        return keep(out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha256", F.lower(F.hex("class"))).alias("kept_sha256")), "phrases")
