"""Toxicity: a convolutional text classifier, trained in numpy by Spark tasks.

Words (lower-cased, without the punctuation at their ends) are embedded as the sum
of hashed features: the word, its beginnings and its end, so that a word never
seen in training still has a place. Filters of several widths run over the
sequence; max pooling keeps each filter's strongest answer in the document; a
linear layer makes the probability. Max pooling passes gradients to one window
per filter and document, which keeps training cheap.

All labelled rows are used, texts of any length whole. They are dealt into
shards, each trained on by one task, in rounds of one shard, then two, four and
so on; a round starts from the average of the models of the round before (an
embedding is averaged over the shards that moved it).

Thresholds are calibrated by language on training rows kept aside (every fifth),
from their counts by score, in steps of 1 / ``SCORE_STEPS``: for each language
the raw score with the best F1 is moved to the common threshold. The
language is guessed from the letters of the text; no label, language, source
or id column is an input of a score.

Corner cases: a null or empty text is scored as a document of padding only; a
text of any length is scored whole; without labels of both classes the score
is 0 for every document. Repeated rows get equal scores; rows with a null id
are scored (and are not held out); an empty table gives an empty result.
"""

from __future__ import annotations

import copy
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import arrow_rows, small_batches, texts_of
from sylvan.llm.training import (
    VECTOR_ROWS, Adam, best_threshold, deal, in_turn, is_aside, labelled_rows, move_threshold, sigmoid, sum_vectors, training_rounds,
    vector_rows, word_buckets,
)
from sylvan.session import Scratch

BUCKETS = 1 << 15
WIDTHS = (1, 2, 3)
SIZE, FILTERS = 12, 8  # of an embedding; filters of each width
PAD = max(WIDTHS) - 1  # padding words after each window start
EPOCHS, BATCH, RATE = 6, 32, 0.01  # epochs of the first round; later ones take each row once
LEAST_STEPS = 600
LATER_RATE = 0.003
LEAST_DOCS = 2
INITIAL = 0.1
THRESHOLD = 0.7
SCORE_STEPS = 10_000
WORDS_HELD = 300_000
PART_WORDS = 20_000

ENDS = ".,;:!?\"'()[]"
#: Letters that tell the languages of Latin script apart; none: English.
LETTERS = {"de": "äöüß", "es": "ñíóáú", "fr": "éèêçàô"}
LANGUAGES = ("en", *LETTERS)
LEAST_SHARE = 0.005
_other = re.compile("[^%s]+" % "".join(LETTERS.values()))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def features(word: str) -> list[int]:
    return word_buckets(word.strip(ENDS), BUCKETS)


def language(text: str) -> int:
    """Index in LANGUAGES, from the share of each language's letters."""
    if text.isascii():
        return 0
    left = _other.sub("", text)
    counts = [sum(map(left.count, letters)) for letters in LETTERS.values()]
    best = int(np.argmax(counts))
    return 1 + best if counts[best] >= LEAST_SHARE * len(text) else 0


@dataclass
class ConvModel:
    table: np.ndarray  # bucket -> embedding
    filters: dict[int, np.ndarray]  # width -> (width * SIZE, FILTERS)
    bias: np.ndarray  # one for each filter
    out: np.ndarray
    out_bias: float
    thresholds: np.ndarray  # raw, by language

    def _answers(self, words: np.ndarray, table: np.ndarray, width: int) -> np.ndarray:
        parts = self.filters[width].reshape(width, SIZE, FILTERS)
        total = (table @ parts[0])[words]
        for j in range(1, width):
            shifted = (table @ parts[j])[words[j:]]
            total[: len(words) - j] += shifted
        return total


def embed(table: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Embeddings of words from their buckets, ``sizes`` of them each in
    ``flat``; row 0 is padding (zero)."""
    if not len(sizes):
        return np.zeros((1, SIZE), dtype=np.float32)
    summed = np.add.reduceat(table[flat], np.cumsum(sizes) - sizes, axis=0)
    return np.concatenate([np.zeros((1, SIZE), dtype=np.float32), summed / np.sqrt(sizes)[:, None].astype(np.float32)])


class Buckets:
    """The buckets of numbered words, as two arrays: a list of numbers for each
    word would take ten times the memory."""

    def __init__(self):
        self.flat, self.ends = array("i"), array("q", [0])

    def add(self, buckets: list[int]) -> None:
        self.flat.extend(buckets)
        self.ends.append(len(self.flat))

    def settle(self) -> None:
        self.flat = np.frombuffer(self.flat, dtype=np.int32) if len(self.flat) else np.zeros(0, dtype=np.int32)
        self.ends = np.frombuffer(self.ends, dtype=np.int64)

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of ``words`` one after the other, and how many each has."""
        sizes = self.ends[words + 1] - self.ends[words]
        first = np.repeat(self.ends[words] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[first + np.arange(int(sizes.sum()))], sizes

    def keep(self, shared: np.ndarray, other: int) -> None:
        """Without the buckets that aren't ``shared``; a word without any left
        has ``other``."""
        word = np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))
        good = shared[self.flat]
        sizes = np.bincount(word[good], minlength=len(self.ends) - 1)
        empty = np.flatnonzero(sizes == 0)
        word, flat = np.append(word[good], empty), np.append(self.flat[good], np.full(len(empty), other))
        self.flat = flat[np.argsort(word, kind="stable")].astype(np.int32)
        self.ends = np.append(0, np.cumsum(np.maximum(sizes, 1)))


class Scorer:
    """Raw scores of texts. For each word seen it holds what every position of
    every filter answers to it, so a window's answer is a sum of looked-up rows."""

    def __init__(self, model: ConvModel):
        self.model = model
        self.parts = np.concatenate([p for w in WIDTHS for p in model.filters[w].reshape(w, SIZE, FILTERS)], axis=1)
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((4096, self.parts.shape[1]), dtype=np.float32)
        self.used = 1  # row 0 is padding

    def _lookup(self, words: list[str]) -> np.ndarray:
        index = self.index
        try:
            return np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))
        except KeyError:
            pass
        new = [w for w in dict.fromkeys(words) if w not in index]
        while self.used + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        found = [features(w) for w in new]
        flat = np.fromiter((b for each in found for b in each), dtype=np.int64)
        rows = embed(self.model.table, flat, np.fromiter(map(len, found), dtype=np.int64, count=len(found)))[1:]
        self.rows[self.used : self.used + len(new)] = rows @ self.parts
        index.update(zip(new, range(self.used, self.used + len(new))))
        self.used += len(new)
        return np.fromiter(map(index.__getitem__, words), dtype=np.int64, count=len(words))

    def _pooled(self, at: np.ndarray) -> np.ndarray:
        """The strongest answer of each filter among windows of ``at``."""
        rows, n, first, found = self.rows[at], len(at), 0, []
        for w in WIDTHS:
            parts = [rows[j : n - PAD + j, first + j * FILTERS : first + (j + 1) * FILTERS] for j in range(w)]
            found.append(sum(parts[1:], parts[0]).max(axis=0))
            first += w * FILTERS
        return np.concatenate(found)

    def raw(self, text: str) -> float:
        """The probability before calibration. Long texts go part by part, with
        PAD words of overlap: the maximum of the parts' maxima."""
        if self.used > WORDS_HELD:
            self.reset()
        at = np.append(self._lookup(words_of(text)), [0] * (PAD + 1))
        best = self._pooled(at[: PART_WORDS + PAD])
        for first in range(PART_WORDS, len(at) - PAD, PART_WORDS):
            best = np.maximum(best, self._pooled(at[first : first + PART_WORDS + PAD]))
        hidden = np.maximum(best + self.model.bias, 0)
        return float(sigmoid(hidden @ self.model.out + self.model.out_bias))

    def score(self, text: str) -> float:
        return float(move_threshold(np.array(self.raw(text)), self.model.thresholds[language(text)], THRESHOLD))


def number_words(texts: list[str]) -> tuple[list[np.ndarray], Buckets]:
    """The documents as numbers of words (from 1), and the words' buckets."""
    index: dict[str, int] = {}
    buckets = Buckets()
    docs = []
    for text in texts:
        words = words_of(text)
        for w in dict.fromkeys(words):
            if w not in index:
                index[w] = len(index) + 1
                buckets.add(features(w))
        docs.append(np.fromiter(chain(map(index.__getitem__, words), [0] * (PAD + 1)), dtype=np.int32, count=len(words) + PAD + 1))
    buckets.settle()
    return docs, buckets


def new_model(seen_in: np.ndarray, seed: int) -> ConvModel:
    """A model to start from. Features of fewer than LEAST_DOCS documents can
    only be learned by heart: they stay zero, so do those of words never seen."""
    rng = np.random.default_rng(seed)
    shared = np.append(seen_in >= LEAST_DOCS, False)
    return ConvModel(
        table=(rng.standard_normal((BUCKETS + 1, SIZE)) * INITIAL * shared[:, None]).astype(np.float32),
        filters={w: (rng.standard_normal((w * SIZE, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS},
        bias=np.zeros(FILTERS * len(WIDTHS), dtype=np.float32),
        out=(rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32),
        out_bias=0.0,
        thresholds=np.full(len(LANGUAGES), 0.5),
    )


def _arrays(model: ConvModel) -> dict[str, np.ndarray]:
    arrays = {"table": model.table, "bias": model.bias, "out": model.out, "b": np.array([model.out_bias], dtype=np.float32)}
    return arrays | {f"f{w}": model.filters[w] for w in WIDTHS}


def learn(
    model: ConvModel, docs: list[np.ndarray], buckets: Buckets, y: np.ndarray, seen_in: np.ndarray, seed: int, first: bool = True
) -> None:
    """Move ``model`` by steps on rows of both classes, half of each batch from
    either: in the ``first`` round EPOCHS times the larger class, later once."""
    rng = np.random.default_rng([seed, 1])
    buckets.keep(seen_in >= LEAST_DOCS, BUCKETS)
    arrays = _arrays(model)
    adam = Adam(arrays, RATE if first else LATER_RATE)
    by_class = [np.flatnonzero(y == c) for c in (0, 1)]
    half = BATCH // 2
    steps = -(-max(map(len, by_class)) // half)
    if first:
        steps = max(LEAST_STEPS, EPOCHS * steps)
    order = [in_turn(rng, rows, steps * half) for rows in by_class]
    for at in range(0, steps * half, half):
        chosen = np.concatenate([rows[at : at + half] for rows in order])
        _step(model, adam, [docs[i] for i in chosen], y[chosen], buckets)
    model.out_bias = float(arrays["b"][0])


def calibrate(model: ConvModel, raw: np.ndarray, y: np.ndarray, lang: np.ndarray, weight: np.ndarray) -> None:
    """Thresholds from raw scores of rows kept aside; ``weight``: how many rows
    each stands for."""
    common = best_threshold(raw, y, weight) if len(raw) else 0.5
    for k in range(len(LANGUAGES)):
        own = lang == k
        rows, toxic = weight[own].sum(), (y * weight)[own].sum()
        enough = rows >= 20 and 5 <= toxic < rows
        model.thresholds[k] = best_threshold(raw[own], y[own], weight[own]) if enough else common


def train(rows: pd.DataFrame, seed: int = 5) -> ConvModel | None:
    """Fit on labelled rows (text, y) that one process holds, as ``fit`` does on
    a table; None without both classes. Every fifth row is kept aside."""
    if rows["y"].nunique() < 2:
        return None
    texts, y = texts_of(rows["text"]), rows["y"].to_numpy(dtype=np.float32)
    aside = np.arange(len(texts)) % 5 == 4
    if len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    docs, buckets = number_words(texts)
    seen_in = np.zeros(BUCKETS, dtype=np.int64)
    for doc in docs:
        held = np.unique(doc)
        seen_in[np.unique(buckets.of(held[held > 0] - 1)[0])] += 1
    model = new_model(seen_in, seed)
    learn(model, [docs[i] for i in np.flatnonzero(~aside)], buckets, y[~aside], seen_in, seed)
    score = Scorer(model).raw
    kept = [texts[i] for i in np.flatnonzero(aside)]
    raw, lang = np.array([score(t) for t in kept]), np.array([language(t) for t in kept], dtype=np.int64)
    calibrate(model, raw, y[aside], lang, np.ones(len(kept)))
    return model


def count_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The number of this task's documents that hold each feature."""
    found: dict[str, list[int]] = {}
    seen_in = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for text in texts_of(batch["text"]):
            if len(found) > WORDS_HELD:
                found.clear()
            held: set[int] = set()
            for w in set(words_of(text)):
                if w not in found:
                    found[w] = features(w)
                held.update(found[w])
            seen_in[np.fromiter(held, dtype=np.int64, count=len(held))] += 1
    yield vector_rows(TaskContext.get().partitionId(), seen_in)


def train_round(rows: DataFrame, model: ConvModel, seen_in: np.ndarray, seed: int, first: bool) -> None:
    """Move ``model`` to the average of the models that the shards make of it,
    by their rows; an embedding by those of the shards that moved it."""
    names = sorted(set(_arrays(model)) - {"table"})

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        shard = int(frame["shard"].iloc[0])
        frame = frame.sort_values(["h", "text"], ignore_index=True)
        y = frame["y"].to_numpy(dtype=np.float32)
        if len(set(y.tolist())) < 2:
            return vector_rows(shard, np.zeros(0))
        own = copy.deepcopy(model)
        docs, buckets = number_words(texts_of(frame["text"]))
        learn(own, docs, buckets, y, seen_in, seed + shard, first)
        old, new = _arrays(model), _arrays(own)
        moved = (new["table"] != old["table"]).any(axis=1)
        change = [(new[k] - old[k]).ravel() for k in names]
        vector = np.concatenate([(new["table"] - old["table"]).ravel(), moved, *change, [1.0]])
        return vector_rows(shard, vector.astype(np.float64) * len(frame))

    total = sum_vectors(rows.groupBy("shard").applyInPandas(work, VECTOR_ROWS))
    if total is None:
        return
    arrays, weight, at = _arrays(model), total[-1], model.table.size
    moved = total[at : at + len(model.table), None]
    model.table += np.divide(total[:at].reshape(model.table.shape), moved, out=np.zeros(model.table.shape), where=moved > 0).astype(np.float32)
    at += len(model.table)
    for k in names:
        arrays[k] += (total[at : at + arrays[k].size].reshape(arrays[k].shape) / weight).astype(np.float32)
        at += arrays[k].size
    model.out_bias = float(arrays["b"][0])


def score_counts(rows: DataFrame, model: ConvModel) -> pd.DataFrame:
    """How many rows have each language, label and raw score (in steps)."""
    held: dict[str, Scorer] = {}

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = held.setdefault("scorer", Scorer(model)).raw
        for batch in batches:
            texts = texts_of(batch["text"])
            steps = [round(score(t) * SCORE_STEPS) for t in texts]
            yield pd.DataFrame({"lang": [language(t) for t in texts], "step": steps, "y": batch["y"]})

    scored = rows.select("text", "y").mapInPandas(work, "lang int, step int, y int")
    # languages x steps x labels at most
    return scored.groupBy("lang", "step", "y").count().orderBy("lang", "step", "y").toPandas()


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, held_out: int = 1, seed: int = 5) -> ConvModel | None:
    """A model from all labelled documents whose remainder is not ``held_out``;
    None without both classes."""
    spark = docs.sparkSession
    with Scratch(spark, "toxicity") as scratch, arrow_rows(spark):
        rows = scratch.save(labelled_rows(docs, labels, label, modulus, held_out).withColumn("aside", is_aside()), "rows")
        totals = rows.groupBy("aside", "y").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
        if len({r["y"] for r in totals}) < 2:
            return None
        learned, kept = rows.where("not aside"), rows.where("aside")
        if len({r["y"] for r in totals if not r["aside"]}) == 2:
            totals = [r for r in totals if not r["aside"]]
        else:  # the few rows of a class are all aside
            learned, kept = rows, rows.where(F.lit(False))
        counts = {y: sum(r["n"] for r in totals if r["y"] == y) for y in (0, 1)}
        seen_in = sum_vectors(rows.select("text").mapInPandas(count_features, VECTOR_ROWS))
        model = new_model(seen_in, seed)
        for k, each in enumerate(training_rounds(sum(r["chars"] for r in totals))):
            train_round(deal(learned, each, counts), model, seen_in, seed, first=k == 0)
        found = score_counts(kept, model)
        calibrate(
            model, found["step"].to_numpy() / SCORE_STEPS, found["y"].to_numpy(dtype=np.float32), found["lang"].to_numpy(),
            found["count"].to_numpy(dtype=np.float64),
        )
    return model


def _step(model: ConvModel, adam: Adam, docs: list[np.ndarray], y: np.ndarray, buckets: Buckets) -> None:
    flat = np.concatenate(docs)
    starts = np.cumsum([0, *map(len, docs[:-1])])
    seen, local = np.unique(flat, return_inverse=True)
    real = seen[seen > 0]
    shift = len(seen) - len(real)  # 1 if padding is among them
    table = embed(model.table, *buckets.of(real - 1))
    local = local + (1 - shift)
    widths = {w: model._answers(local, table, w) for w in WIDTHS}
    # a window that starts in the last PAD places reaches into the next document
    ends = np.append(starts[1:], len(flat))
    across = (ends[:, None] - 1 - np.arange(PAD)).ravel()
    for answers in widths.values():
        answers[across] = -np.inf
    pooled = np.concatenate([np.maximum.reduceat(a, starts, axis=0) for a in widths.values()], axis=1)
    hidden = np.maximum(pooled + model.bias, 0)
    p = sigmoid(hidden @ model.out + adam.arrays["b"][0])
    error = (p - y) / len(y)
    grads = {"out": hidden.T @ error, "b": np.array([error.sum()], dtype=np.float32)}
    back = np.outer(error, model.out) * (pooled + model.bias > 0)
    grads["bias"] = back.sum(axis=0)
    to_words = np.zeros_like(table)
    for k, w in enumerate(WIDTHS):
        answers = widths[w]
        top = np.empty((len(docs), FILTERS), dtype=np.int64)
        for d, (a, b) in enumerate(zip(starts, ends)):
            top[d] = a + answers[a:b].argmax(axis=0)
        g = back[:, k * FILTERS : (k + 1) * FILTERS]  # docs x filters
        parts = model.filters[w].reshape(w, SIZE, FILTERS)
        grad = np.zeros_like(parts)
        for j in range(w):
            at = np.minimum(top + j, len(flat) - 1)
            word = np.where(top + j < len(flat), local[at], 0)  # docs x filters
            grad[j] = np.einsum("dfs,df->sf", table[word], g)
            np.add.at(to_words, word.ravel(), (g[:, :, None] * parts[j].T[None]).reshape(-1, SIZE))
        grads[f"f{w}"] = grad.reshape(w * SIZE, FILTERS)
    to_words[0] = 0
    adam.update({k: g.astype(np.float32) for k, g in grads.items()})
    moved = np.flatnonzero(np.abs(to_words).sum(axis=1))
    if len(moved):
        flat_b, sizes = buckets.of(real[moved - 1] - 1)
        grad_b = np.repeat(to_words[moved] / np.sqrt(sizes)[:, None].astype(np.float32), sizes, axis=0)
        touched, where = np.unique(flat_b, return_inverse=True)
        summed = np.zeros((len(touched), SIZE), dtype=np.float32)
        np.add.at(summed, where, grad_b)
        known = touched < BUCKETS
        adam.update_rows("table", touched[known], summed[known])


def score_column(model: ConvModel | None, text_col: str = "text") -> Column:
    """The calibrated score of a text column, 0 to 1."""
    if model is None:
        return F.lit(0.0)

    held: dict[str, Scorer] = {}

    @F.pandas_udf("double")
    def toxicity(texts: pd.Series) -> pd.Series:
        if "scorer" not in held:
            held["scorer"] = Scorer(model)
        score = held["scorer"].score
        return pd.Series([score(t) for t in texts_of(texts)], dtype="float64")

    return toxicity(F.col(text_col))


def score_documents(docs: DataFrame, model: ConvModel | None, text_col: str = "text") -> DataFrame:
    """The rows with ``toxicity`` and ``is_toxic`` added."""
    small_batches(docs.sparkSession)
    scored = docs.withColumn("toxicity", score_column(model, text_col))
    return scored.withColumn("is_toxic", F.col("toxicity") >= THRESHOLD)
