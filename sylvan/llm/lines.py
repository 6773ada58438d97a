"""Quality rules: line sequence labelling by a linear-chain conditional random
field, and counts over words and lines.

Each line of a document with a word is content or boilerplate. The field's
potential of a labelling is the sum, over the lines, of a weight for each
feature and label, plus a weight for each pair of neighbouring labels; Viterbi
decoding finds the best labelling of the whole document in one pass. A document
is kept if the share of its word characters that stand in content lines is at
least ``LEAST_CONTENT`` (and the plain rules do not fail it).

The weights are trained here by maximum likelihood (forward-backward, Adam) on
a bounded sample of documents; their lines get their labels from the document's
quality label, corrected by two plain signs: a line that is mostly symbols,
capitals or repeats is boilerplate wherever it stands, and an ordinary sentence
in a rejected document is content.

Plain counts are taken from whole texts, exactly: words are runs of characters
that are not ASCII white space.

Corner cases: a null or empty text has no words or lines (all counts zero, not
kept); a text of any length is processed whole; without a model (no labelled
documents) the plain rules alone decide. Repeated rows give equal results; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import small_batches, texts_of
from sylvan.llm.training import Adam, labelled_sample

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
LEAST_CONTENT = 0.5
BOILERPLATE, CONTENT = 0, 1

SAMPLE_ROWS = 1000  # labelled documents of each class
CHAIN = 200  # longest stretch of lines in a training chain
STEPS, RATE = 150, 0.1

FEATURES = (
    "bias", "short", "long", "ends_mark", "symbols", "many_symbols", "capitals", "digits", "marks", "neighbour_words",
    "distinct_words", "starts_capital", "seen_before", "link", "word_length", "many_repeats",
)


def line_features(line: str, seen: bool) -> list[float]:
    words = line.split()
    n, size = max(1, len(words)), max(1, len(line))
    symbols = sum(map(line.count, SYMBOLS))
    raw = np.bincount(np.frombuffer(line.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    upper, lower = int(raw[65:91].sum()), int(raw[97:123].sum())
    digits = int(raw[48:58].sum())
    marks = int(raw[33] + raw[63])
    counts = Counter(words)
    repeats = sum(map(eq, words, words[1:]))
    return [
        1.0, float(n <= 3), float(n >= 10), float(line.rstrip().endswith((".", "!", "?", ":", ";", "…"))),
        min(1.0, 5 * symbols / size), float(5 * symbols > n), float(upper > lower), min(1.0, 5 * digits / size),
        min(1.0, marks / n), repeats / n, len(counts) / n, float(line.lstrip()[:1].isupper()),
        float(seen), float("://" in line or "www." in line), min(2.0, len(line) / n / 10),
        float(4 * repeats > n),
    ]


def lines_of(text: str) -> list[str]:
    return [line for line in text.split("\n") if line.strip(SPACES)]


def chain_features(lines: list[str]) -> np.ndarray:
    before: set[str] = set()
    rows = []
    for line in lines:
        rows.append(line_features(line, line in before))
        before.add(line)
    return np.array(rows).reshape(-1, len(FEATURES))


@dataclass
class LineModel:
    weights: np.ndarray  # features x labels
    pairs: np.ndarray  # label x next label

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The best labelling of a chain of lines."""
        if not len(features):
            return np.zeros(0, dtype=np.int64)
        own = (features @ self.weights).tolist()
        (t00, t01), (t10, t11) = self.pairs.tolist()
        b, c = own[0]
        back = []
        for e0, e1 in own[1:]:
            from0, from1 = b + t00 >= c + t10, b + t01 >= c + t11  # the better one before is boilerplate
            back.append((0 if from0 else 1, 0 if from1 else 1))
            b, c = (b + t00 if from0 else c + t10) + e0, (b + t01 if from1 else c + t11) + e1
        label = int(c >= b)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])

    def content_share(self, text: str) -> float:
        """Share of the word characters that stand in content lines."""
        lines = lines_of(text)
        if not lines:
            return 0.0
        labels = self.viterbi(chain_features(lines))
        sizes = np.array([len(x) - sum(map(x.count, SPACES)) for x in lines], dtype=np.float64)
        return float(sizes[labels == CONTENT].sum() / sizes.sum())


def line_labels(features: np.ndarray, good: bool) -> np.ndarray:
    """Training labels of a document's lines."""
    f = dict(zip(FEATURES, features.T))
    junk = (f["many_symbols"] > 0) | (f["capitals"] > 0) | (f["many_repeats"] > 0) | (f["distinct_words"] < 0.3)
    sentence = (f["ends_mark"] > 0) & (f["symbols"] == 0) & (f["seen_before"] == 0) & (f["distinct_words"] > 0.5) & (f["marks"] < 0.3)
    return np.where(junk, BOILERPLATE, np.where(sentence, CONTENT, CONTENT if good else BOILERPLATE))


def train(sample: pd.DataFrame) -> LineModel | None:
    """Maximum likelihood on the sample's chains (text, y)."""
    chains = []
    for text, y in zip(texts_of(sample["text"]), sample["y"]):
        features = chain_features(lines_of(text))
        labels = line_labels(features, y == 1) if len(features) else None
        chains += [(features[a : a + CHAIN], labels[a : a + CHAIN]) for a in range(0, len(features), CHAIN)]
    if not chains:
        return None
    longest = max(len(x) for x, _ in chains)
    x = np.zeros((len(chains), longest, len(FEATURES)))
    y = np.zeros((len(chains), longest), dtype=np.int64)
    real = np.zeros((len(chains), longest))
    for k, (features, labels) in enumerate(chains):
        x[k, : len(features)], y[k, : len(labels)], real[k, : len(features)] = features, labels, 1
    wanted = np.eye(2)[y] * real[:, :, None]
    joint = real[:, 1:]
    wanted_pairs = np.einsum("kta,ktb,kt->ab", np.eye(2)[y[:, :-1]], np.eye(2)[y[:, 1:]], joint)
    model = LineModel(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)))
    adam = Adam({"weights": model.weights, "pairs": model.pairs}, RATE)
    total = real.sum()
    for _ in range(STEPS):
        own = np.exp(np.clip(x @ model.weights, -30, 30))
        step = np.exp(model.pairs)
        forward = np.empty_like(own)
        forward[:, 0] = own[:, 0] / own[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            f = (forward[:, t - 1] @ step) * own[:, t]
            forward[:, t] = np.where(real[:, t, None] > 0, f / f.sum(axis=1, keepdims=True), forward[:, t - 1])
        backward = np.ones_like(own)
        for t in range(longest - 2, -1, -1):
            b = (backward[:, t + 1] * own[:, t + 1]) @ step.T
            backward[:, t] = np.where(real[:, t + 1, None] > 0, b / b.sum(axis=1, keepdims=True), 1.0)
        single = forward * backward
        single /= single.sum(axis=2, keepdims=True)
        pairs = forward[:, :-1, :, None] * step * (own * backward)[:, 1:, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        got = single * real[:, :, None]
        adam.update({
            "weights": np.einsum("ktf,kta->fa", x, got - wanted) / total + 1e-4 * model.weights,
            "pairs": (np.einsum("ktab,kt->ab", pairs, joint) - wanted_pairs) / total + 1e-4 * model.pairs,
        })
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, **sample) -> LineModel | None:
    """A model from at most ``rows`` labelled documents of each class."""
    return train(labelled_sample(docs, labels, label, modulus=5, held_out=0, rows=rows, **sample))


def plain_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode("utf-8", "replace").split()  # bytes: ASCII white space only
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = lines_of(text)
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    repeated = 0
    if len(counts) < len(windows):
        covered = np.zeros(n, dtype=bool)
        at = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
        for k in range(WINDOW):
            covered[k : k + len(at)] |= at
        repeated = int(covered.sum())
    return n, chars, symbols, dup, repeated


def judge_lines(docs: DataFrame, model: LineModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, the plain counts, ``base_failed``, ``content_share``
    and ``kept``."""
    small_batches(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = texts_of(batch["text"])
            out = pd.DataFrame([plain_counts(t) for t in texts], columns=names, dtype="int64")
            out.insert(0, "key", batch["key"].to_numpy())
            failed = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > MOST_REPEATED * out["n_words"])
            share = [1.0 if model is None else model.content_share(t) for t in texts]
            out["base_failed"], out["content_share"] = failed, share
            out["kept"] = ~failed & (out["content_share"] >= LEAST_CONTENT)
            yield out

    key = docs.select(id_col).schema[0].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInPandas(
        work, f"key {key}, " + "".join(f"{n} long, " for n in names) + "base_failed boolean, content_share double, kept boolean"
    )
    return out.withColumnRenamed("key", id_col)
