"""Personal data: fixed patterns with checks, and a conditional random field that adds what they miss.

Patterns (e-mail, IP, card, phone) are read in every line that holds a digit or an at sign; no other line
can match. The field is a linear chain over the words of such lines near a word with a digit, an at sign
or a plus: each word has features of its shape and its neighbours' shapes, weights and transitions are
fitted by maximum likelihood on a small labelled table, and the best labelling is decoded by Viterbi over
numpy batches of segments. Spans of the field that touch a pattern's span are left out, the rest are
added as kinds ``crf_email`` and so on.

Null and empty texts have no spans, repeated rows one result each, an empty table none; without any labelled
word the field adds nothing. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, texts, utf8

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pattern_spans(line: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the checked matches in one line, by start, then kind."""
    found = []
    done = at = 0
    while (at := line.find("@", at)) >= 0:
        local = line[done:at]
        start = at - (len(local) - len(local.rstrip(_LOCAL)))
        m = _DOMAIN.match(line, at + 1) if start < at else None
        at += 1
        if m:
            found.append((start, 0, m.end()))
            done = at = m.end()
    for m in _IP.finditer(line):
        if all(len(g.lstrip("0")) <= 3 and int(g[-3:]) <= 255 for g in m.groups()):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(line):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in line:
        for m in _PHONE.finditer(line):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def marked_lines(body: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, first byte, last byte) of the lines that hold a digit or an at sign, in order."""
    is_mark = np.zeros(256, bool)
    is_mark[48:58] = is_mark[64] = True
    marks = np.flatnonzero(is_mark[body])
    if not len(marks):
        return []
    borders = np.unique(np.concatenate([starts, np.flatnonzero(body == 10) + 1]))
    lines = np.unique(np.searchsorted(borders, marks, side="right") - 1)
    docs = np.searchsorted(starts, borders[lines], side="right") - 1
    return list(zip(docs.tolist(), borders[lines].tolist(), borders[lines + 1].tolist()))


# --- the field -----------------------------------------------------------------------------------------------------

LABELS = ("other", *KINDS)
FEATURES = 1 << 13
_WORD = re.compile(r"[^\s]+")
_CONTEXT = 2


def _shape(word: str) -> str:
    return "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word[:40])


def _short(shape: str) -> str:
    return re.sub(r"(.)\1+", r"\1", shape)


def segments(line: str) -> list[list[tuple[int, int, str]]]:
    """Words (start, end, text) near a marked one, as unbroken runs."""
    words = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(line)]
    keep = sorted({k for i, (_, _, w) in enumerate(words) if re.search(r"[0-9@+]", w) for k in range(max(0, i - _CONTEXT), min(len(words), i + _CONTEXT + 1))})
    out: list[list[tuple[int, int, str]]] = []
    last = -2
    for k in keep:
        if k != last + 1:
            out.append([])
        out[-1].append(words[k])
        last = k
    return out


class FeatureMaker:
    """Feature numbers of a word between its neighbours; remembered for a bounded number of shapes."""

    WIDTH = 10

    def __init__(self):
        self.known: dict[tuple, list[int]] = {}

    def of(self, words: list[str]) -> list[list[int]]:
        shapes = [_shape(w) for w in words]
        short = ["^", *map(_short, shapes), "$"]
        out = []
        for i, shape in enumerate(shapes):
            key = (shape, len(words[i]), short[i], short[i + 2])
            if key not in self.known:
                if len(self.known) > 100_000:
                    self.known.clear()
                digits = shape.count("9")
                names = (
                    f"s{shape}", f"c{short[i + 1]}", f"f{shape[:1]}", f"l{shape[-1:]}", f"n{min(len(words[i]), 24)}", f"d{min(digits, 20)}",
                    f"k{'@' in shape}{shape.count('.')}{'-' in shape}{'(' in shape}", f"p{short[i]}", f"x{short[i + 2]}", f"pc{short[i]}|{short[i + 1]}",
                )
                self.known[key] = [zlib.crc32(n.encode()) % FEATURES for n in names]
            out.append(self.known[key])
        return out


@dataclass
class ChainField:
    weights: np.ndarray  # features x labels
    moves: np.ndarray  # from label x to label
    begin: np.ndarray

    @classmethod
    def fit(cls, sequences: list[tuple[list[list[int]], list[int]]], epochs: int = 80, rate: float = 0.1, penalty: float = 1e-4) -> ChainField:
        """Maximum likelihood by gradient steps with adapted rates over all sequences at once."""
        n = len(LABELS)
        params = [np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros(n)]
        if not sequences:
            params[2][0] = 10.0
            return cls(*params)
        feats, mask, gold = _padded(sequences)
        size, steps = mask.shape
        onehot = np.eye(n)[gold] * mask[..., None]
        pair_gold = np.einsum("stl,stm->lm", onehot[:, :-1], onehot[:, 1:])
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for epoch in range(1, epochs + 1):
            w, moves, begin = params
            emit = w[feats].sum(2)
            alpha = np.zeros((size, steps, n))
            beta = np.zeros((size, steps, n))
            alpha[:, 0] = emit[:, 0] + begin
            for t in range(1, steps):
                new = _lse(alpha[:, t - 1, :, None] + moves, 1) + emit[:, t]
                alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
            for t in range(steps - 2, -1, -1):
                new = _lse(moves[None] + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
            total = _lse(alpha[:, -1], 1)
            near = np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
            pairs = np.zeros((n, n))
            for t in range(1, steps):
                joint = alpha[:, t - 1, :, None] + moves[None] + (emit[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
                pairs += (np.exp(np.minimum(joint, 0)) * mask[:, t, None, None]).sum(0)
            diff = onehot - near
            grad_w = np.zeros_like(w)
            np.add.at(grad_w, feats.reshape(-1, feats.shape[2]), diff.reshape(-1, 1, n))
            grads = [grad_w / size - penalty * w, (pair_gold - pairs) / size, diff[:, 0].sum(0) / size]
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**epoch)) / (np.sqrt(v / (1 - 0.99**epoch)) + 1e-8)
        return cls(*params)

    def decode(self, sequences: list[list[list[int]]]) -> list[list[int]]:
        """Best labels of each sequence, by Viterbi over batches of sequences of similar length."""
        out: list[list[int]] = [[] for _ in sequences]
        order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
        at = 0
        while at < len(order):
            widest = 32_768
            stop = at + 1
            while stop < len(order) and (stop - at + 1) * len(sequences[order[stop]]) <= widest:
                stop += 1
            part = order[at:stop]
            at = stop
            feats, mask, _ = _padded([(sequences[k], [0] * len(sequences[k])) for k in part])
            emit = self.weights[feats].sum(2)
            size, steps, n = emit.shape
            score = emit[:, 0] + self.begin
            back = np.zeros((size, steps, n), np.int8)
            for t in range(1, steps):
                options = score[:, :, None] + self.moves
                best = options.argmax(1)
                new = np.take_along_axis(options, best[:, None], 1)[:, 0] + emit[:, t]
                here = mask[:, t, None]
                back[:, t] = np.where(here, best, np.arange(n))
                score = np.where(here, new, score)
            label = score.argmax(1)
            path = np.zeros((size, steps), np.int8)
            for t in range(steps - 1, -1, -1):
                path[:, t] = label
                label = back[np.arange(size), t, label]
            for row, k in enumerate(part):
                out[k] = path[row, : len(sequences[k])].tolist()
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def _padded(sequences):
    longest = max(len(s) for s, _ in sequences)
    feats = np.zeros((len(sequences), longest, FeatureMaker.WIDTH), np.int32)
    mask = np.zeros((len(sequences), longest), bool)
    gold = np.zeros((len(sequences), longest), np.int8)
    for k, (s, labels) in enumerate(sequences):
        feats[k, : len(s)], mask[k, : len(s)], gold[k, : len(s)] = s, True, labels
    return feats, mask, gold


def label_table(docs: DataFrame, rows: int = 400) -> DataFrame:
    """The labelled table: ``rows`` texts with a digit or an at sign, chosen by a hash, with their checked spans.

    The bound is this parameter; the labels come from the patterns, so the field learns from words that
    passed their checks and from look-alikes that failed them.
    """
    marked = texts(docs).filter(F.col("text").rlike("[0-9@]")).withColumn("_key", F.xxhash64("doc_id", "text"))
    keys = [r._key for r in marked.select("_key").orderBy("_key").limit(rows).collect()]
    lines = F.slice(F.filter(F.split("text", "\n"), lambda x: x.rlike("[0-9@]")), 1, 20)
    chosen = marked.filter(F.col("_key") <= F.lit(max(keys, default=0)))
    return chosen.dropDuplicates(["_key"]).orderBy("_key").limit(rows).select(lines.alias("lines"))


def train(labelled: list[list[str]], longest: int = 40) -> ChainField:
    """Fit the field to lines labelled by the patterns; segments beyond ``longest`` words are cut for training."""
    maker, sequences = FeatureMaker(), []
    for line in (x for lines in labelled for x in lines):
        spans = pattern_spans(line)
        for words in segments(line):
            words = words[:longest]
            labels = [next((kind + 1 for a, kind, b in spans if a < y and x < b), 0) for x, y, _ in words]
            sequences.append((maker.of([w for _, _, w in words]), labels))
    return ChainField.fit(sequences[:4000])


def field_spans(field: ChainField, maker: FeatureMaker, lines: list[str], known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the field adds to the ``known`` ones of each line: (start, kind, end)."""
    parts = [(k, words) for k, line in enumerate(lines) for words in segments(line)]
    out: list[list[tuple[int, int, int]]] = [[] for _ in lines]
    for (k, words), labels in zip(parts, field.decode([maker.of([w for _, _, w in words]) for _, words in parts])):
        i = 0
        while i < len(words):
            j = i
            while j + 1 < len(words) and labels[j + 1] == labels[i]:
                j += 1
            a, b = words[i][0], words[j][1]
            body = lines[k][a:b]
            if labels[i] and not any(x < b and a < y for x, _, y in known[k]) and _plausible(labels[i] - 1, body):
                out[k].append((a, labels[i] - 1, b))
            i = j + 1
    return out


def _plausible(kind: int, body: str) -> bool:
    """A last check: what a person could use as such an address or number."""
    digits = sum(c.isdigit() for c in body)
    if kind == 0:
        return "@" in body.strip("@")
    if kind == 1:
        return body.count(".") >= 3 and digits >= 4
    if kind == 2:
        return 12 <= digits <= 19 and not any(c.isalpha() for c in body)
    return 9 <= digits <= 15 and not any(c.isalpha() for c in body)


def pii_report(docs: DataFrame, rows: int = 400) -> DataFrame:
    """``doc_id``, counts of the four kinds, the digest of their spans, and all spans with the added ones."""
    field = train([r.lines for r in label_table(docs, rows).collect()])
    weights = (field.weights.astype(np.float32), field.moves, field.begin)

    def make():
        chain, maker = ChainField(*weights), FeatureMaker()
        empty = hashlib.sha256(b"").hexdigest()

        def step(batch: pa.RecordBatch) -> dict:
            body, starts = utf8(batch.column(1))
            size = len(starts) - 1
            counts, digests, all_spans = np.zeros((size, len(KINDS)), np.int64), [empty] * size, [""] * size
            marked = marked_lines(body, starts)
            lines = [body[a:b].tobytes().decode() for _, a, b in marked]
            known = [pattern_spans(line) for line in lines]
            added = field_spans(chain, maker, lines, known)
            at = 0
            while at < len(marked):
                doc, stop = marked[at][0], at
                base, more = [], []
                lead, place, points = None, int(starts[doc]), 0
                while stop < len(marked) and marked[stop][0] == doc:
                    if known[stop] or added[stop]:
                        lead = body[place : marked[stop][1]]
                        points += int(((lead & 0xC0) != 0x80).sum())
                        place = marked[stop][1]
                        base += [(x + points, kind, y + points) for x, kind, y in known[stop]]
                        more += [(x + points, len(KINDS) + kind, y + points) for x, kind, y in added[stop]]
                    stop += 1
                at = stop
                if base or more:
                    name = lambda k: KINDS[k] if k < len(KINDS) else f"crf_{KINDS[k - len(KINDS)]}"
                    for _, kind, _ in base:
                        counts[doc, kind] += 1
                    digests[doc] = hashlib.sha256(",".join(f"{KINDS[k]}:{x}:{y}" for x, k, y in sorted(base)).encode()).hexdigest()
                    all_spans[doc] = ",".join(f"{name(k)}:{x}:{y}" for x, k, y in sorted(base + more))
            out = {"doc_id": batch.column(0), "base_sha256": digests, "spans": all_spans}
            return out | {f"n_{k}": counts[:, i] for i, k in enumerate(KINDS)}

        return step

    named = ", ".join(f"n_{k} long" for k in KINDS)
    return arrow_map(texts(docs), make, f"doc_id long, {named}, base_sha256 string, spans string")
