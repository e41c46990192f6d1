"""Secrets found by one automaton for all rules.

Detection is one pass over the bytes of a batch with the combined automaton (``automaton.Automaton``): it
says which stretches of text hold a match of which rule. Only there are exact spans read, with an
automaton of each rule, leftmost longest and without overlap within a kind.

Null and empty texts have no spans. Repeated rows give one result each, an empty table none. Columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folio.llm.automaton import Automaton
from folio.llm.base import arrow_map, portions, texts, tidied, utf8


def any_case(word: str) -> str:
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", word)


_KEY = any_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"

#: kind, pattern of a match, pattern of a match that counts, and what the combined automaton looks for: a
#: string that every match that counts holds, short enough to keep the product of counters small. The first
#: three are the base kinds.
_JWT = r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
_PEM = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
RULES = (
    ("assign", f"{_KEY}{_VALUE}+", f"{_KEY}{_VALUE}{{6,}}", f"{_KEY}{_VALUE}{{6}}"),
    ("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{16,}", "AKIA[A-Z0-9]{4}"),
    ("hex", "[0-9a-f]+", "[0-9a-f]{24,}", "[0-9a-f]{24}"),
    ("pem", _PEM, _PEM, "-----BEGIN "),
    ("jwt", _JWT, _JWT, "eyJ[A-Za-z0-9_-]"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{20,}", "gh[pousr]_[A-Za-z0-9]"),
    ("slack", "xox[abprs]-[0-9A-Za-z-]+", "xox[abprs]-[0-9A-Za-z-]{10,}", "xox[abprs]-[0-9A-Za-z-]"),
)
KINDS = tuple(rule[0] for rule in RULES)
BASE = 3


class SecretScanner:
    """``spans(body, starts)``: for each text its spans (kind number, start byte, end byte) in order."""

    def __init__(self, rules=RULES):
        self.combined = Automaton([signal for _, _, _, signal in rules], search=True)
        self.match = [Automaton([pattern], search=False).ready() for _, pattern, _, _ in rules]
        self.counts = [Automaton([pattern], search=False).ready() for _, _, pattern, _ in rules]

    def spans(self, body: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, int, int]]]:
        found = [[] for _ in range(len(starts) - 1)]
        borders, seen = self.combined.lanes(body, starts)
        hits = np.flatnonzero(seen)
        docs = np.searchsorted(starts, borders[hits], side="right") - 1
        for lane, doc in zip(hits.tolist(), docs.tolist()):
            a, b = int(borders[lane]), int(borders[lane + 1])
            data = body[a:b].tobytes()
            for kind, (match, counts) in enumerate(zip(self.match, self.counts)):
                if seen[lane] >> kind & 1:
                    shift = a - int(starts[doc])
                    for x, y in match.matches(data):
                        if counts.longest(data[x:y], 0) == y - x:
                            found[doc].append((kind, x + shift, y + shift))
        return found


def code_points(data: bytes, places: list[int]) -> dict[int, int]:
    """Places in bytes as places in code points."""
    at = sorted(set(places))
    lead = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    sums = np.concatenate([[0], np.cumsum(lead)])
    return {p: int(sums[p]) for p in at}


def _digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, text, spans``: an array of ``kind, start, end, value`` for each document, by start, then kind."""

    def make():
        scanner = SecretScanner()

        def step(batch: pa.RecordBatch) -> dict:
            body, starts = utf8(batch.column(1))
            rows = []
            for k, spans in enumerate(scanner.spans(body, starts)):
                if spans:
                    data = body[starts[k] : starts[k + 1]].tobytes()
                    cp = code_points(data, [p for _, x, y in spans for p in (x, y)])
                    spans = sorted((cp[x], kind, cp[y], data[x:y].decode()) for kind, x, y in spans)
                rows.append([{"kind": KINDS[kind], "start": x, "end": y, "value": v} for x, kind, y, v in spans])
            return {"doc_id": batch.column(0), "text": batch.column(1), "spans": pa.array(rows, span_type)}

        return step

    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
    return arrow_map(texts(docs), make, "doc_id long, text string, spans array<struct<kind string, start long, end long, value string>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of base spans, and all spans as text."""

    def make():
        scanner = SecretScanner()
        empty = _digest([])

        def step(batch: pa.RecordBatch) -> dict:
            body, starts = utf8(batch.column(1))
            out = {"doc_id": batch.column(0), **{f"n_{k}": [] for k in KINDS[:BASE]}, "base_sha256": [], "spans": []}
            for k, spans in enumerate(scanner.spans(body, starts)):
                if not spans:
                    for kind in KINDS[:BASE]:
                        out[f"n_{kind}"].append(0)
                    out["base_sha256"].append(empty)
                    out["spans"].append("")
                    continue
                cp = code_points(body[starts[k] : starts[k + 1]].tobytes(), [p for _, x, y in spans for p in (x, y)])
                spans = sorted((cp[x], kind, cp[y]) for kind, x, y in spans)
                said = [(kind, f"{KINDS[kind]}:{x}:{y}") for x, kind, y in spans]
                for kind in range(BASE):
                    out[f"n_{KINDS[kind]}"].append(sum(s[0] == kind for s in said))
                out["base_sha256"].append(_digest([s for kind, s in said if kind < BASE]))
                out["spans"].append(",".join(s for _, s in said))
            return out | {f"n_{k}": pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS[:BASE]}

        return step

    counts = ", ".join(f"n_{k} long" for k in KINDS[:BASE])
    return arrow_map(texts(docs), make, f"doc_id long, {counts}, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[{kind}]") -> DataFrame:
    """``docs`` with every secret replaced by its kind; overlapping spans are replaced as one, named by the first.

    All columns are kept, a null text stays null.
    """

    names = docs.columns
    at = names.index("text")

    def make():
        scanner = SecretScanner()

        def step(batch: pa.RecordBatch) -> dict:
            column = batch.column(at)
            body, starts = utf8(column.fill_null(""))
            changed = column.to_pylist()
            for k, spans in enumerate(scanner.spans(body, starts)):
                if not spans:
                    continue
                data, out, done = body[starts[k] : starts[k + 1]].tobytes(), [], 0
                for x, kind, y in sorted((x, kind, y) for kind, x, y in spans):
                    if x >= done:
                        out += [data[done:x], mark.format(kind=KINDS[kind]).encode()]
                    done = max(done, y)
                changed[k] = b"".join([*out, data[done:]]).decode()
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            return columns | {"text": pa.array(changed, pa.string())}

        return step

    def run(batches):
        step = make()
        for batch in portions(batches):
            columns = step(batch)
            yield pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], batch.schema.names)

    return docs.mapInArrow(tidied(run), docs.schema)
