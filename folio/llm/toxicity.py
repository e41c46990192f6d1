"""Toxicity by a weighted lexicon.

Texts are folded first: case, accents, look-alike letters of other scripts and digits or signs that stand for
letters inside a word; whatever is no letter then is a blank. Entries are whole words and word beginnings of
four to seven letters (many insults come in inflected forms). Their weights are log odds between toxic and
other labelled documents; half of the fitting rows give the lexicon, the other half the logistic curve over
a document's weight, its weight by length, and its hits. One Aho-Corasick automaton finds all entries; an
exception phrase covers the entries inside it.

Null and empty texts have no hits and get the score of such texts. Repeated rows get equal scores, an empty
table an empty result; without labels of both kinds the lexicon is empty and every score the smoothed share
of label 1. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, in_fold, texts
from folio.llm.labelled import FIT_ROWS, fit_rows, lasso_logistic
from folio.session import materialize

# Letters of other scripts that look like Latin ones (fixed values), in pairs.
_ALIKE = "аaвbеeіiјjкkмmнhоoрpсcтtуyхxѕsԁdԛqԝwαaβbεeικιiκkνvοoρpτtυuχxѵvɡgıiɑaƅbⅼl"
_SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_STANDS = re.compile(r"(?<![0-9@$!])[013457@$!]{1,3}(?=[a-z])")

#: Phrases in which a listed word is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "class clown", "stupid simple", "loser bracket")
BEGINNINGS = (4, 5, 6, 7)
#: Entries of the lexicon at most, the heaviest.
ENTRIES = 2000


class _Fold(dict):
    """Translation of one character, worked out when it is first met."""

    def __missing__(self, code: int):
        c = chr(code)
        if c in _SIGNS:
            to = c
        else:
            parts = unicodedata.normalize("NFKD", c.lower())
            to = "".join(x for x in parts if not unicodedata.combining(x))
            to = "".join(_PAIRS.get(x, x) for x in to)
            if unicodedata.category(c) in ("Cf", "Mn"):
                to = ""
            elif not to.isalpha():
                to = to if to in _SIGNS else " "
        self[code] = to
        return to


_PAIRS = {}
for _a, _b in zip(_ALIKE[::2], _ALIKE[1::2]):
    if _b.isascii():
        _PAIRS[_a] = _b
_REST = str.maketrans({c: " " for c in "0123456789@$!"})


def fold(text: str, table: _Fold) -> str:
    """Folded words with one blank around each."""
    text = text.translate(table)
    text = _STANDS.sub(lambda m: "".join(_SIGNS[c] for c in m[0]), text)
    return f" {' '.join(text.translate(_REST).split())} "


def candidates(words: set[str]) -> set[str]:
    """Entries a document counts for: `` word `` and `` begin``."""
    out = {f" {w} " for w in words if 3 <= len(w) <= 24}
    for size in BEGINNINGS:
        out.update(" " + w[:size] for w in words if len(w) > size)
    return out


def learn_lexicon(docs: DataFrame, rows: DataFrame, least: int = 5, entries: int = ENTRIES) -> dict[str, float]:
    """Entries with their weights from the documents of ``rows`` (``doc_id, label``, bounded).

    An entry needs ``least`` toxic documents and odds that are above e even at the lower end of their
    uncertainty; one that a shorter beginning makes superfluous is left out.
    """
    chosen = texts(docs).join(F.broadcast(rows), "doc_id").select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, counts, size = _Fold(), (Counter(), Counter()), [0, 0]

        def flush():
            names = list({*counts[0], *counts[1]})
            columns = [pa.array(names, pa.string()), pa.array([counts[1][n] for n in names], pa.int64()), pa.array([counts[0][n] for n in names], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["entry", "toxic", "other"])
            counts[0].clear()
            counts[1].clear()

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(candidates(set(fold(text, table).split())))
                size[label] += 1
                if len(counts[0]) > 500_000:
                    yield from flush()
        counts[1][""], counts[0][""] = size[1], size[0]
        yield from flush()

    found = chosen.mapInArrow(run, "entry string, toxic long, other long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    found = materialize(found.filter((F.col("toxic") >= least) | (F.col("entry") == "")), "lexicon")
    total = found.filter("entry = ''").first()
    if not total or not total.toxic or not total.other:
        return {}
    weight = F.log((F.col("toxic") + 0.5) / (total.toxic + 1)) - F.log((F.col("other") + 0.5) / (total.other + 1))
    doubt = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("other") + 0.5))
    good = found.filter("entry <> ''").select("entry", weight.alias("weight"), doubt.alias("doubt")).filter("weight - 1.64 * doubt > 1")
    kept: dict[str, float] = {}
    for row in sorted(good.orderBy(F.col("weight").desc(), "entry").limit(entries).collect(), key=lambda r: (len(r.entry), r.entry)):
        shorter = max((kept.get(row.entry[:k], 0.0) for k in range(5, len(row.entry))), default=0.0)
        if row.weight > shorter + 0.5:
            kept[row.entry] = row.weight
    return kept


FEATURES = ("weight", "density", "hits")


def toxic_hits(docs: DataFrame, lexicon: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> DataFrame:
    """``doc_id, weight, density, hits, words``: what the lexicon finds in each whole text."""

    def make():
        import ahocorasick

        table = _Fold()
        automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            automaton.add_word(entry, (len(entry), weight))
        for phrase in exceptions:
            automaton.add_word(folded := fold(phrase, table), (len(folded), None))
        automaton.make_automaton()

        def step(batch: pa.RecordBatch) -> dict:
            out = {"doc_id": batch.column(0), "weight": [], "density": [], "hits": [], "words": []}
            for text in batch.column(1).to_pylist():
                folded = fold(text, table)
                at: dict[int, float] = {}
                covered = []
                for end, (size, weight) in automaton.iter(folded):
                    start = end - size + 1
                    if weight is None:
                        covered.append((start, end))
                    elif weight > at.get(start, 0.0):
                        at[start] = weight
                if covered:
                    at = {k: w for k, w in at.items() if not any(a <= k < b for a, b in covered)}
                words, total = folded.count(" ") - 1, sum(at.values())
                out["weight"].append(float(np.log1p(total)))
                out["density"].append(float(np.log1p(100 * total / max(words, 10))))
                out["hits"].append(float(np.log1p(len(at))))
                out["words"].append(words)
            return out

        return step

    return arrow_map(texts(docs), make, "doc_id long, weight double, density double, hits double, words long")


def toxicity_scores(docs: DataFrame, labels: DataFrame, parts: int = 4, rest: int = 2, threshold: float = 0.3, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, hits`` for every document."""
    chosen = materialize(fit_rows(labels, "toxic", in_fold("doc_id", parts, rest), rows), "fit")
    half = F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), F.lit(2)) == 0
    lexicon = learn_lexicon(docs, chosen.filter(half))
    found = materialize(toxic_hits(docs, lexicon), "hits")
    data = found.dropDuplicates(["doc_id"]).join(F.broadcast(chosen.filter(~half)), "doc_id").select("doc_id", "label", *FEATURES).toPandas().sort_values("doc_id")
    x = data[list(FEATURES)].to_numpy(float)
    weights, intercept = lasso_logistic(np.column_stack([x, x[:, 1:2] ** 2, x > 0]) if len(x) else np.zeros((0, 7)), data["label"].to_numpy(float), 1e-4, steps=2000)
    total = F.lit(float(intercept))
    parts_ = [F.col(f) for f in FEATURES] + [F.col("density") * F.col("density")] + [(F.col(f) > 0).cast("double") for f in FEATURES]
    for w, part in zip(weights, parts_):
        total = total + part * float(w)
    score = 1 / (1 + F.exp(-total))
    rows_ = found.select("doc_id", in_fold("doc_id", parts, rest).alias("held_out"), score.alias("score"), F.round(F.exp("hits") - 1).cast("long").alias("hits"))
    return rows_.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")
