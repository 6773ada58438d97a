"""Document quality: a second-order factorisation machine, trained in numpy.

Inputs x of a document: its words (hashed; share of the document's words,
scaled), structure statistics (shares of capitals, digits, symbols, marks,
repeated words and lines, word and line lengths) and its own metadata (length
and number of lines as steps). Each input has a weight and ``FACTORS`` factors; pairs
of inputs interact by the product of their factors. All pairs together take
linear time by

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The score's threshold is calibrated on training rows kept aside. Labels,
language, source and id columns are never inputs.

Corner cases: a null or empty text is scored by its statistics (all zero); a
text of any length is scored whole; without labels of both classes the score
is 1 for every document. Repeated rows get equal scores; rows with a null id
are scored (and are not held out); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import small_batches, texts_of
from sylvan.llm.training import Adam, best_threshold, labelled_sample, move_threshold, sigmoid

BUCKETS = 1 << 15
FACTORS = 6
WORD_SCALE = 4.0
LEAST_DOCS = 2  # features of fewer documents stay zero
EPOCHS, BATCH, RATE = 6, 32, 0.01
LEAST_STEPS = 600
THRESHOLD = 0.3
WORDS_HELD = 400_000

SYMBOLS = b"#*$%&|<>"
#: Steps of the metadata inputs.
CHARS_STEPS = (100, 300, 1_000, 3_000, 10_000, 30_000)
LINES_STEPS = (1, 3, 10, 30, 100)
STATISTICS = 14
DENSE = STATISTICS + len(CHARS_STEPS) + 1 + len(LINES_STEPS) + 1


def _steps(value: int, steps: tuple[int, ...]) -> list[float]:
    at = sum(value > s for s in steps)
    return [float(at == k) for k in range(len(steps) + 1)]


def dense_inputs(text: str, words: list[str], counts: Counter) -> list[float]:
    """Structure statistics, each about 0 to 1, and metadata steps."""
    raw = text.encode("utf-8", "replace")
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n, size = max(1, len(words)), max(1, len(raw))
    upper, lower, digits = int(of[65:91].sum()), int(of[97:123].sum()), int(of[48:58].sum())
    marks = [int(of[ord(c)]) for c in "!?.,"]
    lines = [line for line in text.split("\n") if line.strip()]
    statistics = [
        upper / max(1, upper + lower), digits / size, 10 * int(of[list(SYMBOLS)].sum()) / size,
        (marks[0] + marks[1]) / n, min(1.0, 4 * marks[2] / n), min(1.0, 4 * marks[3] / n),
        len(counts) / n, sum(map(eq, words, words[1:])) / n, max(counts.values(), default=0) / n,
        min(2.0, size / n / 10), 1 - len(set(lines)) / max(1, len(lines)), min(2.0, n / max(1, len(lines)) / 50),
        1 - int(of[65:91].sum() + of[97:123].sum() + of[128:].sum() + of[32] + of[10]) / size, float(not words),
    ]
    return statistics + _steps(len(text), CHARS_STEPS) + _steps(len(lines), LINES_STEPS)


def word_inputs(counts: Counter, n: int) -> np.ndarray:
    return np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) * (WORD_SCALE / max(1, n))


def bucket(word: str) -> int:
    return xxhash.xxh32_intdigest(word.lower().encode("utf-8", "replace"), 3) % BUCKETS


@dataclass
class FactorModel:
    weight: np.ndarray  # of each input: buckets, then dense ones
    factors: np.ndarray
    bias: float
    threshold: float = 0.5

    def value(self, at: np.ndarray, x: np.ndarray) -> float:
        """The machine's value for inputs ``at`` with values ``x``."""
        v = self.factors[at]
        sums = x @ v
        squares = (x * x) @ (v * v)
        return float(self.bias + x @ self.weight[at] + 0.5 * (sums @ sums - squares.sum()))


class Scorer:
    """Scores of texts; the inputs of words seen before are looked up."""

    def __init__(self, model: FactorModel):
        self.model = model
        self.index: dict[str, int] = {}
        self.dense = np.arange(BUCKETS, BUCKETS + DENSE)

    def inputs(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        counts = Counter(words)
        index = self.index
        try:
            at = np.fromiter(map(index.__getitem__, counts), dtype=np.int64, count=len(counts))
        except KeyError:
            if len(index) > WORDS_HELD:
                index.clear()
            index.update((w, bucket(w)) for w in counts if w not in index)
            at = np.fromiter(map(index.__getitem__, counts), dtype=np.int64, count=len(counts))
        x = np.concatenate([word_inputs(counts, len(words)), dense_inputs(text, words, counts)])
        return np.concatenate([at, self.dense]), x

    def raw(self, text: str) -> float:
        return float(sigmoid(np.array(self.model.value(*self.inputs(text)))))

    def score(self, text: str) -> float:
        return float(move_threshold(np.array(self.raw(text)), self.model.threshold, THRESHOLD))


def train(sample: pd.DataFrame, seed: int = 11) -> FactorModel | None:
    """Fit on a labelled sample (text, y, weight); None without both classes.
    Every fifth row is kept aside for the threshold."""
    if sample["y"].nunique() < 2:
        return None
    rng = np.random.default_rng(seed)
    model = FactorModel(
        weight=np.zeros(BUCKETS + DENSE), factors=rng.standard_normal((BUCKETS + DENSE, FACTORS)) * 0.05, bias=0.0
    )
    scorer = Scorer(model)
    docs = [(at.astype(np.int32), x) for at, x in map(scorer.inputs, texts_of(sample["text"]))]
    scorer.index.clear()
    seen_in = np.bincount(np.concatenate([np.unique(at) for at, _ in docs]), minlength=BUCKETS + DENSE)
    shared = seen_in >= LEAST_DOCS
    shared[BUCKETS:] = True
    model.factors[~shared] = 0
    y = sample["y"].to_numpy(dtype=np.float64)
    aside = np.arange(len(docs)) % 5 == 4
    rows = np.flatnonzero(~aside)
    by_class = [rows[y[rows] == c] for c in (0, 1)]
    if not all(map(len, by_class)):
        return None
    bias = np.zeros(1)
    adam = Adam({"weight": model.weight, "factors": model.factors, "bias": bias}, RATE)
    for _ in range(max(LEAST_STEPS, EPOCHS * max(map(len, by_class)) * 2 // BATCH)):
        chosen = np.concatenate([rng.choice(c, BATCH // 2) for c in by_class])
        flat = np.concatenate([docs[i][0] for i in chosen])
        x = np.concatenate([docs[i][1] for i in chosen])
        starts = np.cumsum([0, *[len(docs[i][0]) for i in chosen[:-1]]])
        sizes = np.diff(np.append(starts, len(flat)))
        v = model.factors[flat]
        xv = x[:, None] * v
        sums = np.add.reduceat(xv, starts, axis=0)
        value = bias[0] + np.add.reduceat(x * model.weight[flat], starts)
        value += 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((xv**2).sum(axis=1), starts))
        error = (sigmoid(value) - y[chosen]) / BATCH
        each = np.repeat(error, sizes)
        gv = (each * x)[:, None] * (np.repeat(sums, sizes, axis=0) - xv)
        touched, where = np.unique(flat, return_inverse=True)
        gw = np.bincount(where, weights=each * x, minlength=len(touched))
        gf = np.stack([np.bincount(where, weights=gv[:, f], minlength=len(touched)) for f in range(FACTORS)], axis=1)
        known = shared[touched]
        adam.update({"bias": np.array([error.sum()])})
        adam.update_rows("weight", touched[known], gw[known] + 1e-5 * model.weight[touched[known]])
        adam.update_rows("factors", touched[known], gf[known] + 1e-5 * model.factors[touched[known]])
    model.bias = float(bias[0])
    kept = np.flatnonzero(aside)
    if len(kept):
        raw = sigmoid(np.array([model.value(*docs[i]) for i in kept]))
        model.threshold = best_threshold(raw, y[kept], sample["weight"].to_numpy()[kept])
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, held_out: int = 0, **sample) -> FactorModel | None:
    """A model from the labelled documents whose remainder is not ``held_out``."""
    return train(labelled_sample(docs, labels, label, modulus, held_out, **sample))


def score_column(model: FactorModel | None, text_col: str = "text") -> Column:
    """The calibrated score of a text column, 0 to 1."""
    if model is None:
        return F.lit(1.0)

    held: dict[str, Scorer] = {}

    @F.pandas_udf("double")
    def quality(texts: pd.Series) -> pd.Series:
        if "scorer" not in held:
            held["scorer"] = Scorer(model)
        score = held["scorer"].score
        return pd.Series([score(t) for t in texts_of(texts)], dtype="float64")

    return quality(F.col(text_col))


def score_documents(docs: DataFrame, model: FactorModel | None, text_col: str = "text") -> DataFrame:
    """The rows with ``quality`` and ``is_good`` added."""
    small_batches(docs.sparkSession)
    scored = docs.withColumn("quality", score_column(model, text_col))
    return scored.withColumn("is_good", F.col("quality") >= THRESHOLD)
