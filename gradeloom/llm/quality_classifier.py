"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on a bounded sample of labelled documents; every path from a root
is a rule, a conjunction of limits on statistics. A lasso logistic regression keeps few
of the rules. The kept rules become Spark column expressions, so scoring a corpus is one
pass that measures the texts and a native expression over the figures.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import slices

#: Labelled rows that a fit reads at most (the ones with the smallest hash of their id).
SAMPLE_ROWS = 20_000
TREES = 40
DEPTH = 3
PENALTY = 0.002
THRESHOLD = 0.3
SEED = 11

FEATURES = (
    "log_bytes", "log_words", "word_length", "symbol_share", "mark_share", "upper_share", "digit_share",
    "space_share", "distinct_words", "distinct_lines", "line_length", "line_end_share", "odd_word_share", "pipe_share",
)

_SYMBOLS = np.frombuffer(b"#*$%&<>{}[]\\^~=_", np.uint8)
_MARKS = np.frombuffer(b"!?;:", np.uint8)
_WORD_ENDS = frozenset(b"!#*$%&|<>=~^")
_LINE_ENDS = (b".", b"!", b"?", b'"', b"'", b")", b":")


def text_features(raw: bytes) -> tuple[float, ...]:
    """The figures named in ``FEATURES`` for one whole text; all zero for an empty one."""
    if not raw:
        return (0.0,) * len(FEATURES)
    n = len(raw)
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [s for line in raw.split(b"\n") if (s := line.strip())]
    letters = int(bytes_[65:91].sum() + bytes_[97:123].sum()) or 1
    n_words, n_lines = len(words) or 1, len(lines) or 1
    return (
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        (n - int(bytes_[32] + bytes_[9:14].sum())) / n_words,
        float(bytes_[_SYMBOLS].sum()) / n,
        float(bytes_[_MARKS].sum()) / n,
        float(bytes_[65:91].sum()) / letters,
        float(bytes_[48:58].sum()) / n,
        float(bytes_[32] + bytes_[9:14].sum()) / n,
        len(set(words)) / n_words,
        len(set(lines)) / n_lines,
        float(np.log1p(n / n_lines)),
        sum(s.endswith(_LINE_ENDS) for s in lines) / n_lines,
        sum(w[-1] in _WORD_ENDS for w in words) / n_words,
        float(bytes_[124]) / n,
    )


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and the figures of ``FEATURES`` for every row of ``docs``."""
    kept = docs.select("doc_id", "text", *keep)
    schema = ", ".join(
        ["doc_id long", *(f"{c} {dict(kept.dtypes)[c]}" for c in keep), *(f"{c} double" for c in FEATURES)]
    )
    names = ["doc_id", *keep, *FEATURES]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [text_features(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
            figures = [pa.array(c, pa.float64()) for c in zip(*rows)]
            others = [part.column(2 + i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *others, *figures], names=names)

    return kept.mapInArrow(measure, schema)


@dataclass(frozen=True)
class Rule:
    """A conjunction of limits ``(feature, above, value)``: above means greater than, else at most."""

    limits: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for feature, above, value in self.limits:
            out &= (x[:, feature] > value) == above
        return out

    def column(self, figure: Callable[[str], Column] = F.col) -> Column:
        out = F.lit(True)
        for feature, above, value in self.limits:
            c = figure(FEATURES[feature])
            out = out & ((c > value) if above else (c <= value))
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weighted: tuple[tuple[float, Rule], ...]

    def score(self, figure: Callable[[str], Column] = F.col) -> Column:
        """The probability of a good document, over the columns that ``figure`` gives for the statistics."""
        total = F.lit(self.intercept)
        for weight, rule in self.weighted:
            total = total + F.when(rule.column(figure), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int, path: tuple = ()) -> list[tuple]:
    """Paths to every node of one tree, split where the summed squared error falls most."""
    if depth == 0 or len(y) < 40 or y.min() == y.max():
        return []
    best = (1e-9, -1, 0.0)
    n, total = len(y), y.sum()
    base = total * total / n
    for feature in rng.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False):
        values = x[:, feature]
        for value in np.unique(np.quantile(values, np.linspace(0.02, 0.98, 25))):
            right = values > value
            k = int(right.sum())
            if min(k, n - k) < 10:
                continue
            s = y[right].sum()
            gain = (s * s / k + (total - s) ** 2 / (n - k) - base) / n
            if gain > best[0]:
                best = (gain, int(feature), float(value))
    if best[1] < 0:
        return []
    _, feature, value = best
    right = x[:, feature] > value
    out = []
    for above, side in ((False, ~right), (True, right)):
        here = (*path, (feature, above, value))
        out += [here, *_grow(x[side], y[side], rng, depth - 1, here)]
    return out


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> list[Rule]:
    """Distinct paths of trees grown on random halves of the rows."""
    rng = np.random.default_rng(seed)
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rows = rng.choice(len(y), max(1, min(len(y) // 2, 4000)), replace=False)
        for path in _grow(x[rows], y[rows], rng, depth):
            rules[Rule(tuple(sorted(set(path))))] = None
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of the L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = z.shape
    design = np.hstack([np.ones((n, 1)), z])
    v = np.ones(k + 1)
    for _ in range(20):  # the largest eigenvalue bounds the step
        v = design.T @ (design @ v)
        v /= np.linalg.norm(v)
    step = 1 / max(0.25 * float(v @ (design.T @ (design @ v))) / n * 1.05, 1e-9)
    w = np.zeros(k + 1)
    w[0] = np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    ahead, t = w.copy(), 1.0
    shrink = np.full(k + 1, penalty * step)
    shrink[0] = 0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        new = ahead - step * (design.T @ (p - y)) / n
        new = np.sign(new) * np.maximum(np.abs(new) - shrink, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    """A model of any labelled sample; without both labels it is a constant."""
    if len(y) == 0 or y.min() == y.max():
        return RuleModel(0.0 if len(y) == 0 else float(np.log((y.mean() + 0.01) / (1.01 - y.mean()))), ())
    rules = tree_rules(x, y)
    if not rules:
        return RuleModel(float(np.log((y.mean() + 0.01) / (1.01 - y.mean()))), ())
    z = np.column_stack([r.holds(x) for r in rules]).astype(float)
    intercept, weights = lasso_logistic(z, y)
    kept = [(float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6]
    return RuleModel(intercept, tuple(kept))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, divisible by five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> RuleModel:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    A document labelled twice counts by its lower label; labels without a document, and
    null labels, are left out.
    """
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("double").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # the chosen ids are at most sample_rows rows of 16 bytes
    labelled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = statistics(labelled, "_quality").limit(2 * sample_rows).toPandas()
    sample = sample.sort_values(["doc_id", *FEATURES])  # the same model whatever order the rows came in
    return fit(sample[list(FEATURES)].to_numpy(float), sample["_quality"].to_numpy(float))


def score_documents(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts get the score of the all-zero statistics; a null id counts as
    not held out; repeated rows score alike. Other columns are ignored.
    """
    return (
        statistics(docs)
        .withColumn("score", model.score())
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "score",
            (F.col("score") >= threshold).cast("int").alias("predicted"),
        )
    )


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score at least ``threshold``."""

    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_features((t or "").encode()) for t in texts], columns=list(FEATURES), dtype=float)

    figures = F.pandas_udf(measure, ", ".join(f"{c} double" for c in FEATURES))
    scored = docs.withColumn("_figures", figures("text"))
    score = model.score(lambda c: F.col(f"_figures.{c}"))
    return scored.where(score >= threshold).drop("_figures")
