"""Quality scores by a sparse ensemble of rules.

Statistics of a text (words, symbols, case, repetition, lines) are computed in one pass. Small trees on
bootstrap samples of the labelled rows give rules, the conjunctions on the way to each node; a lasso logistic
model keeps few of them; what is kept becomes one Spark column expression over the statistics.

Null and empty texts have all statistics 0 and get a score like any other. Repeated rows get equal scores, an
empty table an empty result; without labels of both kinds every score is the smoothed share of label 1. Columns
other than ``doc_id`` and ``text`` are ignored; statistics are named ``stat_...``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.base import arrow_map, in_fold, texts, utf8
from folio.llm.labelled import FIT_ROWS, fit_rows, lasso_logistic
from folio.llm.perplexity import repeated_words
from folio.session import materialize

STATS = (
    "words", "word_chars", "symbol_share", "upper_share", "digit_share", "stop_share", "shout_share", "pipe_share", "distinct_share",
    "top_share", "repeat_share", "dup_line_share", "line_words", "ended_lines", "stutter_share", "short_share", "foreign_share", "blank_share",
)
_ENDS = tuple(b".!?:;\"')")


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SETS = {
    "symbol": _flags(b"#*$%&<>=~^_+@{}[]\\"),
    "upper": _flags(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _flags(b"abcdefghijklmnopqrstuvwxyz"),
    "digit": _flags(b"0123456789"),
    "stop": _flags(b".,;:?"),
    "shout": _flags(b"!"),
    "pipe": _flags(b"|"),
    "foreign": _flags(bytes(range(0xC0, 0x100))),
    "blank": _flags(b" \t\n\r\x0b\x0c"),
}


def _stats_step():
    def step(batch: pa.RecordBatch) -> dict:
        body, starts = utf8(batch.column(1))
        per = {}
        for name, table in _SETS.items():
            sums = np.concatenate([[0], np.cumsum(table[body], dtype=np.int32)])
            per[name] = (sums[starts[1:]] - sums[starts[:-1]]).astype(float)
        size = np.diff(starts).astype(float)
        rows = np.zeros((len(size), 9))
        for k in range(len(size)):
            data = body[starts[k] : starts[k + 1]].tobytes()
            words = data.split()
            n = len(words)
            if not n:
                continue
            count: dict[bytes, int] = {}
            for w in words:
                count[w] = count.get(w, 0) + 1
            lines = [x for x in data.split(b"\n") if x.strip()]
            ended = sum(x[-1] in _ENDS for x in lines)
            stutter = sum(map(bytes.__eq__, words, words[1:]))
            rows[k] = (n, len(count) / n, max(count.values()) / n, repeated_words(words) / n, 1 - len(set(lines)) / len(lines), n / len(lines), ended / len(lines), stutter / n, sum(c for w, c in count.items() if len(w) <= 3) / n)
        n = np.maximum(rows[:, 0], 1)
        letters = np.maximum(per["upper"] + per["lower"], 1)
        values = {
            "words": np.log1p(rows[:, 0]),
            "word_chars": (size - per["blank"]) / n,
            "symbol_share": per["symbol"] / n,
            "upper_share": per["upper"] / letters,
            "digit_share": per["digit"] / np.maximum(size, 1),
            "stop_share": per["stop"] / n,
            "shout_share": per["shout"] / n,
            "pipe_share": per["pipe"] / n,
            "distinct_share": rows[:, 1],
            "top_share": rows[:, 2],
            "repeat_share": rows[:, 3],
            "dup_line_share": rows[:, 4],
            "line_words": np.log1p(rows[:, 5]),
            "ended_lines": rows[:, 6],
            "stutter_share": rows[:, 7],
            "short_share": rows[:, 8],
            "foreign_share": per["foreign"] / np.maximum(size, 1),
            "blank_share": per["blank"] / np.maximum(size, 1),
        }
        return {"doc_id": batch.column(0)} | {f"stat_{k}": pa.array(values[k]) for k in STATS}

    return step


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics ``stat_...`` of each text."""
    return arrow_map(texts(docs), _stats_step, "doc_id long, " + ", ".join(f"stat_{s} double" for s in STATS))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold), all of which hold


def _grow(x: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng, depth: int, path: Rule, out: set[Rule]) -> None:
    """Split on the best of a few random statistics; every node on the way is a rule."""
    if path:
        out.add(tuple(sorted(path)))
    if depth == 0 or len(y) < 40 or y.min() == y.max():
        return
    best = (1e-6, None)
    base = len(y) * y.mean() * (1 - y.mean())
    for f in rng.choice(x.shape[1], size=max(1, x.shape[1] // 3), replace=False):
        if not len(cuts[f]):
            continue
        place = np.searchsorted(cuts[f], x[:, f], side="left")  # cut k lies below where place > k
        n = np.bincount(place, minlength=len(cuts[f]) + 1).cumsum()[:-1]
        s = np.bincount(place, y, minlength=len(cuts[f]) + 1).cumsum()[:-1]
        m, r = len(y) - n, y.sum() - s
        ok = (n >= 15) & (m >= 15)
        if not ok.any():
            continue
        n_, m_ = np.maximum(n, 1), np.maximum(m, 1)
        gain = np.where(ok, base - s * (1 - s / n_) - r * (1 - r / m_), -1)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (int(f), float(cuts[f][k])))
    if best[1] is None:
        return
    f, cut = best[1]
    above = x[:, f] > cut
    for side in (False, True):
        here = above == side
        _grow(x[here], y[here], cuts, rng, depth - 1, (*path, (f, side, cut)), out)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, sample: int = 4000, seed: int = 7) -> list[Rule]:
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.005, 0.995, 60))) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    out: set[Rule] = set()
    for _ in range(trees if len(x) else 0):
        rows = rng.integers(0, len(x), min(sample, len(x)))
        _grow(x[rows], y[rows], cuts, rng, depth, (), out)
    return sorted(out)


def fires(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.all([(x[:, f] > cut) == above for f, above, cut in rule], axis=0) for rule in rules]).astype(float) if rules else np.zeros((len(x), 0))


@dataclass
class RuleEnsemble:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalty: float = 0.002) -> RuleEnsemble:
        rules = tree_rules(x, y)
        weights, intercept = lasso_logistic(fires(rules, x), y, penalty)
        kept = [(r, float(w)) for r, w in zip(rules, weights) if w]
        return cls([r for r, _ in kept], [w for _, w in kept], float(intercept))

    def column(self) -> Column:
        """The score as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            holds = None
            for f, above, cut in rule:
                one = F.col(f"stat_{STATS[f]}") > cut if above else F.col(f"stat_{STATS[f]}") <= cut
                holds = one if holds is None else holds & one
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit_ensemble(stats: DataFrame, labels: DataFrame, column: str, held_out, rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    got = stats.dropDuplicates(["doc_id"]).join(fit_rows(labels, column, held_out, rows), "doc_id").select("label", "doc_id", *[f"stat_{s}" for s in STATS])
    data = got.toPandas().sort_values("doc_id")
    return RuleEnsemble.fit(data[[f"stat_{s}" for s in STATS]].to_numpy(float), data["label"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, parts: int = 5, rest: int = 0, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    stats = materialize(statistics(docs), "stats")
    model = fit_ensemble(stats, labels, "quality", in_fold("doc_id", parts, rest))
    rows = stats.select("doc_id", in_fold("doc_id", parts, rest).alias("held_out"), model.column().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
