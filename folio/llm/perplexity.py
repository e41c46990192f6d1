"""Quality rules with an n-gram perplexity band for each language.

The model is a modified Kneser-Ney model of the bytes of a word between a start and an end mark, trained on all
documents of a language: Spark counts words, then n-grams of words, then distinct left extensions for
the lower orders, and derives discounts and interpolated probabilities by joins. Every word that is scored was counted,
so its n-grams of the highest order are all in the model, and it never backs off. Tasks hold the most frequent
n-grams in memory, ``HELD`` at most, as sorted arrays searched by bisection. Words with any other n-gram are scored
once each by a join with the whole table of n-grams, and their scores joined to the documents they occur in.
None of these joins has a hot key, since what is frequent is held.

A document's score is its mean negative log probability a byte, over all its words. All digits count as the same
byte, so that a number costs what its shape does, in training as in scoring. Scores of a language are summed up by
their quartiles; a document outside ``[q1 - width * spread, q3 + width * spread]`` is rejected, with the spread
at least ``LEAST_SPREAD`` so that a language of copies keeps its variants.

Null and empty texts have no words and fail the base rule. A null language is a language of its own. Repeated
rows each get the same result, an empty table none; columns other than ``doc_id, text, lang`` are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.llm.base import forget, tidied, utf8
from folio.session import materialize, scratch

ORDER = 5
START, END = 2, 3
HELD = 1 << 21
WIDTH, LEAST_SPREAD = 3.0, 0.15
_ROOM = 300_000
# A-Z in lower case, and one class byte for all digits.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", b"abcdefghijklmnopqrstuvwxyz0000000000")


def _with_lang(docs: DataFrame, whole: str | None = None) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        *([F.struct("*").alias(whole)] if whole else []),
    )


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of the highest order, one for each byte and the end mark of a word; and the word of each."""
    joined = b"".join(bytes([START]) * (ORDER - 1) + w + bytes([END]) for w in words)
    body = np.frombuffer(joined, np.uint8).astype(np.int64)
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    places = np.arange(len(owner)) + (owner + 1) * (ORDER - 1)
    packed = np.zeros(len(owner), np.int64)
    for k in range(ORDER):
        packed |= body[places - k] << (8 * k)
    return packed, owner


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, word, n`` over all documents; tasks count first, so a frequent word is few rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        forget()

        def flush():
            for lang, counts in held.items():
                if counts:
                    columns = [pa.array([lang] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for k, (text, lang) in enumerate(zip(batch.column(0), batch.column(1).to_pylist())):
                held.setdefault(lang, Counter()).update(text.as_py().encode().translate(_FOLD).split())
                if k % 64 == 0 and sum(map(len, held.values())) > _ROOM // 2:
                    yield from flush()
        yield from flush()

    rows = _with_lang(docs).select("text", "lang").mapInArrow(tidied(run), "lang string, word binary, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def count_grams(words: DataFrame) -> DataFrame:
    """``lang, gram, n`` of the highest order from counted words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            counts = batch.column(2).to_numpy(zero_copy_only=False)
            for lang in sorted(set(langs)):
                at = np.flatnonzero(langs == lang)
                packed, owner = _grams([batch.column(1)[int(k)].as_py() for k in at])
                grams, place = np.unique(packed, return_inverse=True)
                n = np.bincount(place.ravel(), counts[at][owner]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    return words.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(words: DataFrame) -> list[DataFrame]:
    """For orders 1 to ``ORDER``, from counted words: ``lang, gram, n, p``, the probability of a gram's last byte after the others."""
    c = F.col
    counted = [materialize(count_grams(words), "grams")]
    for k in range(ORDER - 1, 0, -1):  # distinct left extensions
        inner = c("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        counted.insert(0, materialize(counted[0].groupBy("lang", inner.alias("gram")).agg(F.count("*").alias("n")), "grams"))
    out: list[DataFrame] = []
    for k, grams in enumerate(counted, 1):
        of = grams.groupBy("lang").agg(*[F.sum((c("n") == i).cast("double")).alias(f"_n{i}") for i in range(1, 5)])
        y = c("_n1") / F.greatest(c("_n1") + 2 * c("_n2"), F.lit(1.0))
        def discount(i, y=y):
            d = i - (i + 1) * y * c(f"_n{i + 1}") / F.greatest(c(f"_n{i}"), F.lit(1.0))
            return F.least(F.greatest(d, F.lit(0.1)), F.lit(i - 0.1)).alias(f"_d{i}")
        of = materialize(of.select("lang", discount(1), discount(2), discount(3)), "discounts")
        context = F.shiftright("gram", 8)
        cut = F.when(c("n") == 1, c("_d1")).when(c("n") == 2, c("_d2")).otherwise(c("_d3"))
        # Languages are few; should there be very many, the join finds its own way.
        rows = grams.join(F.broadcast(of) if of.count() <= 10_000 else of, "lang").select("lang", "gram", "n", context.alias("_h"), cut.alias("_cut"))
        around = rows.groupBy("lang", "_h").agg(F.sum("n").alias("_sum"), F.sum("_cut").alias("_free"))
        rows = rows.join(around, ["lang", "_h"])
        own, free = (c("n") - c("_cut")) / c("_sum"), c("_free") / c("_sum")
        if not out:
            rows = rows.withColumn("p", own + free / 256.0)
        else:
            below = out[-1].select("lang", c("gram").alias("_low"), c("p").alias("_below"))
            rows = rows.withColumn("_low", c("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below, ["lang", "_low"])
            rows = rows.withColumn("p", own + free * c("_below"))
        out.append(materialize(rows.select("lang", "gram", "n", "p"), "model"))
    return out


def train(docs: DataFrame) -> DataFrame:
    """``lang, k, gram, n, logp`` for orders 1 to ``ORDER``."""
    orders = [x.select("lang", F.lit(k).alias("k"), "gram", "n", F.log("p").alias("logp")) for k, x in enumerate(fit(count_words(docs)), 1)]
    return reduce(DataFrame.union, orders)


class HeldGrams:
    """N-grams in memory, sorted by language and bytes; a gram has 40 bits, so the keys are exact."""

    def __init__(self, langs: dict[str, int], keys: np.ndarray, logp: np.ndarray):
        self.langs, self.keys, self.logp = langs, keys, logp

    def find(self, lang: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each gram, 0 where it is not held; and whether it is."""
        if lang not in self.langs:
            return np.zeros(len(grams)), np.zeros(len(grams), bool)
        keys = grams | self.langs[lang] << 8 * ORDER
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[at] == keys
        return np.where(held, self.logp[at], 0.0), held

    def score(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Log probability of each word with its end mark, nan where a gram of it is not held."""
        packed, owner = _grams(words)
        logp, held = self.find(lang, packed)
        return np.bincount(owner, np.where(held, logp, np.nan), len(words))


def held_grams(top: DataFrame, room: int) -> tuple[HeldGrams, bool]:
    """The most frequent of the grams, ``room`` at most; and whether these are all."""
    level = F.floor(F.log2("n") * 4)
    least, size, whole = None, 0, True
    for r in sorted(top.groupBy(level.alias("level")).count().collect(), reverse=True):
        if size + r["count"] > room:
            whole = False
            break
        least, size = r["level"], size + r["count"]
    if least is None:
        return HeldGrams({}, np.zeros(0, np.int64), np.zeros(0)), whole
    table = top.filter(level >= least).select("lang", "gram", F.log("p").alias("logp")).toArrow()
    lang = table.column("lang").cast(pa.string()).combine_chunks().dictionary_encode()
    keys = table.column("gram").to_numpy() | lang.indices.to_numpy().astype(np.int64) << 8 * ORDER
    order = np.argsort(keys)
    return HeldGrams({x: k for k, x in enumerate(lang.dictionary.to_pylist())}, keys[order], table.column("logp").to_numpy()[order]), whole


def rare_words(words: DataFrame, top: DataFrame, shared) -> DataFrame:
    """``lang, word, logp`` of the words that hold a gram which ``shared`` has not, each by a join with all grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = HeldGrams(*shared.value)
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                at = np.flatnonzero(langs == lang)
                packed, owner = _grams([batch.column(2)[int(k)].as_py() for k in at])
                logp, found = held.find(lang, packed)
                part, missing = np.bincount(owner, logp, len(at)), np.bincount(owner[~found], minlength=len(at))
                rare = missing > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(missing[rare])]), pa.int32()), pa.array(packed[~found]))
                own = batch.take(pa.array(at[rare]))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(part[rare]), lists], ["_word", "lang", "word", "part", "grams"])

    numbered = words.select(F.monotonically_increasing_id().alias("_word"), "lang", "word")
    rare = materialize(numbered.mapInArrow(run, "_word long, lang string, word binary, part double, grams array<long>"), "rare_words")
    pairs = rare.select("_word", "lang", F.explode("grams").alias("gram")).join(top.select("lang", "gram", F.log("p").alias("logp")), ["lang", "gram"])
    sums = pairs.groupBy("_word").agg(F.sum("logp").alias("logp"))
    return materialize(rare.join(sums, "_word").select("lang", "word", (F.col("part") + F.col("logp")).alias("logp")), "word_scores")


_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1B54A32D192ED03, 0xAEF17502108EF2D9], np.uint64)
WINDOW = 5


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more."""
    n = len(words)
    if n <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    with np.errstate(over="ignore"):
        windows = sum(h[k : n - WINDOW + 1 + k] * _MIX[k] for k in range(WINDOW))
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n + 1, np.int64)
    places = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    np.add.at(again, places, 1)
    np.add.at(again, places + WINDOW, -1)
    return int((np.cumsum(again)[:n] > 0).sum())


def _parts(starts: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together, or one long text."""
    edges = np.flatnonzero(np.diff(starts[:-1] // most)) + 1
    return zip([0, *edges.tolist()], [*edges.tolist(), len(starts) - 1])


def _per_text(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
    return (sums[starts[1:]] - sums[starts[:-1]]).astype(np.int64)


def _cost(memory: dict[bytes, float], words: list[bytes]) -> tuple[float, int, Counter]:
    """Sum of the words' values, their size, and those of them that ``memory`` has as nan, which the sum leaves out."""
    found = list(map(memory.__getitem__, words))
    size = sum(map(len, words)) + len(words)
    total, rare = sum(found), Counter()
    if total != total:
        rare.update(w for w, p in zip(words, found) if p != p)
        total = sum(p for p in found if p == p)
    return total, size, rare


_BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def scored(docs: DataFrame, shared, rare: DataFrame | None, keep: Callable[[DataFrame, str], DataFrame], whole: bool = False) -> DataFrame:
    """``doc_id, lang``, the base counts and ``cost`` (mean negative log probability a byte, null without words), written once.

    With ``whole``, each row also has the row of ``docs`` it stands for, as ``_docs``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held = HeldGrams(*shared.value)
        known: dict[str, dict[bytes, float]] = {}

        def measure(body: np.ndarray, starts: np.ndarray, langs: list[str]) -> list[tuple]:
            parts = [body[a:b].tobytes() for a, b in zip(starts, starts[1:])]
            split = [x.split() for x in parts]
            lowered = [[w.translate(_FOLD) for w in words] for words in split]
            for lang in set(langs):
                memory = known.setdefault(lang, {})
                if len(memory) * len(known) > _ROOM:
                    memory.clear()
                fresh = list({w for x, words in zip(langs, lowered) if x == lang for w in words if w not in memory})
                scores = held.score(lang, fresh).tolist() if fresh else []
                memory.update(zip(fresh, scores))
            own = body[starts[0] : starts[-1]]
            chars = _per_text(((own & 0xC0) != 0x80) & ~_BLANK[own], starts - starts[0]).tolist()
            symbols = _per_text(_SYMBOL[own], starts - starts[0]).tolist()
            rows = []
            for lang, part, words, low, n_chars, n_symbols in zip(langs, parts, split, lowered, chars, symbols):
                lines = [x for x in part.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
                rows.append((len(words), n_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words), *_cost(known[lang], low)))
            return rows

        for batch in batches:
            if not batch.num_rows:
                continue
            body, starts = utf8(batch.column(1))
            rows = []
            langs = batch.column(2).to_pylist()
            for at, end in _parts(starts):  # few texts at a time are in words
                rows += measure(body, starts[at : end + 1], langs[at:end])
            *counts, part, size, rare_ = zip(*rows)
            columns = [batch.column(3), batch.column(0), batch.column(2), *[pa.array(x, pa.int64()) for x in counts], pa.array(part, pa.float64()), pa.array(size, pa.int64())]
            columns += [pa.array([list(x) for x in rare_], pa.list_(pa.binary())), pa.array([list(x.values()) for x in rare_], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[4:]], names)

    fields = T.StructType.fromDDL(f"_row long, doc_id long, lang string, {_BASE}, part double, size long, rare array<binary>, times array<long>")
    rows = _with_lang(docs, "_docs" if whole else None).withColumn("_row", F.monotonically_increasing_id())
    own = [x for x in rows.columns if x == "_docs"]
    rows = rows.select("doc_id", "text", "lang", "_row", *own)
    schema = T.StructType([*fields, *[rows.schema[x] for x in own]])
    names = schema.names
    rows = rows.mapInArrow(tidied(run), schema)
    part = F.col("part")
    if rare is not None:
        rows = materialize(rows, "parts")
        pairs = rows.select("_row", "lang", F.explode(F.arrays_zip("rare", "times")).alias("_x")).select("_row", "lang", F.col("_x.rare").alias("word"), F.col("_x.times").alias("times"))
        sums = pairs.join(rare, ["lang", "word"]).groupBy("_row").agg(F.sum(F.col("times") * F.col("logp")).alias("_rest"))
        rows, part = rows.join(sums, "_row", "left"), part + F.coalesce("_rest", F.lit(0.0))
    cost = F.when(F.col("size") > 0, -part / F.col("size"))
    return keep(rows.select("doc_id", "lang", *[x.split()[0] for x in _BASE.split(", ")], cost.alias("cost"), *own), "scored")


def quality_rules(docs: DataFrame, width: float = WIDTH, whole: bool = False) -> DataFrame:
    """The base counts, ``base_failed``, ``cost``, the language's band (``low, high``) and ``kept`` for each document.

    With ``whole``, also the document's own row as ``_docs``.
    """
    with scratch(docs.sparkSession) as keep:
        words = materialize(count_words(docs), "words")
        top = fit(words)[-1]
        held, complete = held_grams(top, HELD)
        shared = docs.sparkSession.sparkContext.broadcast((held.langs, held.keys, held.logp))
        rows = scored(docs, shared, None if complete else rare_words(words, top, shared), keep, whole)
        shared.destroy()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    quartiles = rows.filter(F.col("cost").isNotNull()).groupBy("lang").agg(F.percentile_approx("cost", [0.25, 0.75], 10_000).alias("_q"))
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    spread = F.greatest(q3 - q1, F.lit(LEAST_SPREAD))
    bands = quartiles.select("lang", (q1 - width * spread).alias("low"), (q3 + width * spread).alias("high"))
    inside = F.col("cost").isNull() | F.col("cost").between(F.col("low"), F.col("high"))
    bands = materialize(bands, "bands")
    # A row a language, or a group of null: few; should there be very many, the join finds its own way.
    bands = F.broadcast(bands) if bands.count() <= 10_000 else bands
    return rows.join(bands, "lang", "left").withColumn("kept", ~F.col("base_failed") & inside)
