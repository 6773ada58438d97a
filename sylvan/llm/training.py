"""Labelled documents, hashed word features and Adam, for the classifiers of
this subpackage. ``labelled_rows`` gives all of them, for training in Spark tasks
(``training_rounds``); ``labelled_sample`` a bounded sample, for models trained in
numpy on the driver. Scoring runs on Spark over all rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled rows taken of each class, and the longest text among them
#: (characters; longer documents are scored whole but not trained on).
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 20_000
#: Characters of all sampled texts together: rows beyond it, in the order of
#: their hash, are left out, so the driver's memory has a bound in bytes.
SAMPLE_TOTAL = 24_000_000

#: Characters that a training task is given, about, and rows of each class at
#: least (where there are so many).
SHARD_CHARS = 12_000_000
SHARD_LEAST = 200
#: Numbers of a vector that are summed together.
PIECE = 1 << 14


def bucket_of(id_col: str, modulus: int):
    """The remainder that deals labelled rows into training and held-out ones."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def is_held_out(id_col: str, modulus: int, held_out: int):
    """Whether a row's remainder keeps it out of training; false without an id."""
    return F.coalesce(bucket_of(id_col, modulus) == held_out, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    held_out: int,
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
    total: int = SAMPLE_TOTAL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> pd.DataFrame:
    """At most ``rows`` labelled documents of each class and ``total``
    characters (columns text, y, weight), never those whose remainder is ``held_out``. The ids are chosen by
    hash from the label table alone; ``weight`` undoes the choice: it is the
    number of labelled rows that a row stands for."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (bucket_of(id_col, modulus) != held_out))
    known = known.groupBy(id_col).agg(F.max(label).cast("int").alias("y"))  # a repeated id counts once
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64(id_col), id_col).limit(rows) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])
    # at most 2 * rows ids
    texts = docs.where(F.length(text_col) <= chars).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sampled = (
        texts.join(F.broadcast(chosen.withColumnRenamed(id_col, "id")), "id")
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.max("y").alias("y"))
        .select("text", "y", F.xxhash64("id").alias("h"))
    )
    # the sample's rows only: their number is bounded
    so_far = Window.orderBy("h", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sampled = sampled.withColumn("chars", F.sum(F.length("text")).over(so_far)).where(F.col("chars") <= total).drop("chars")
    found = sampled.toArrow().to_pandas().sort_values(["h", "text"], ignore_index=True)
    counts = found["y"].value_counts()
    found["weight"] = [totals[y] / counts[y] for y in found["y"]]
    return found[["text", "y", "weight"]]


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All labelled documents whose remainder is not ``held_out``: text (null:
    empty), y, and h, the hash of the id. A repeated id counts once."""
    mine = F.col(id_col).isNotNull() & (bucket_of(id_col, modulus) != held_out)
    known = labels.where(F.col(label).isin(0, 1) & mine).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
    texts = docs.where(mine).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(known, "id").groupBy("id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    return rows.select(F.coalesce("text", F.lit("")).alias("text"), "y", F.xxhash64("id").alias("h"))


def is_aside(h: str = "h") -> Column:
    """Every fifth labelled row is kept aside for the thresholds."""
    return F.pmod(F.xxhash64(F.col(h), F.lit(1)), F.lit(5)) == 4


@dataclass(frozen=True)
class Round:
    """Rows whose place (a hash, 0 to 1) is in [low, high), in so many shards."""

    low: float
    high: float
    shards: int


def training_rounds(chars: int, shard_chars: int | None = None) -> list[Round]:
    """Rounds that take every row once: one shard first, then twice as many
    each time, so that a model is averaged from many shards only when it has
    learned from the rounds before."""
    share = min(1.0, (shard_chars or SHARD_CHARS) / max(1, chars))
    found, low, wide = [], 0.0, share
    while low < 1:
        high = min(1.0, low + wide)
        if 1 - high < share / 2:  # no round of a small rest
            high = 1.0
        found.append(Round(low, high, max(1, round((high - low) / share))))
        low, wide = high, 2 * wide
    return found


def deal(rows: DataFrame, each: Round, counts: dict[int, int]) -> DataFrame:
    """The rows of a round with their ``shard``. Of a class that would have too
    few rows in a shard, rows of other rounds are taken as well, and if all of
    them are too few, each is dealt to several shards."""
    place = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)
    shard = F.pmod(F.xxhash64(F.col("h"), F.lit(2)), F.lit(each.shards))
    need = SHARD_LEAST * each.shards
    parts = []
    for y, n in counts.items():
        own = rows.where(F.col("y") == y)
        if n * (each.high - each.low) >= need:
            parts.append(own.where((place >= each.low) & (place < each.high)).withColumn("shard", shard))
        elif n >= need:
            parts.append(own.where(F.pmod(place - each.low, F.lit(1.0)) < need / n).withColumn("shard", shard))
        else:
            copies = min(each.shards, -(-need // n))
            dealt = F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda k: F.pmod(shard + k, F.lit(each.shards)))
            parts.append(own.withColumn("shard", F.explode(dealt)))
    return reduce(DataFrame.unionByName, parts)


def vector_rows(task: int, vector: np.ndarray) -> pd.DataFrame:
    """A task's vector for ``sum_vectors``."""
    pieces = [vector[a : a + PIECE].astype("<f8").tobytes() for a in range(0, len(vector), PIECE)]
    return pd.DataFrame({"task": np.int64(task), "piece": np.arange(len(pieces), dtype=np.int32), "vector": pieces})


VECTOR_ROWS = "task long, piece int, vector binary"


def sum_vectors(rows: DataFrame) -> np.ndarray | None:
    """The sum of the tasks' vectors, added piece by piece in Spark, in the
    order of the tasks; only the sum comes to the driver."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, dtype="<f8") for v in frame.sort_values("task")["vector"])
        return pd.DataFrame({"piece": frame["piece"].iloc[:1], "vector": [total.tobytes()]})

    found = sorted(rows.groupBy("piece").applyInPandas(add, "piece int, vector binary").collect())
    return np.concatenate([np.frombuffer(r["vector"], dtype="<f8") for r in found]) if found else None


def in_turn(rng: np.random.Generator, rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the rows in random order, none again before all had their turn."""
    return np.concatenate([rng.permutation(rows) for _ in range(-(-n // len(rows)))])[:n]


def word_buckets(word: str, size: int) -> list[int]:
    """Hashed features of a word: itself, its beginnings and its end."""
    digest = xxhash.xxh32_intdigest
    grams = {f"<{word}>", f"<{word[:3]}", f"<{word[:4]}", f"<{word[:5]}", f"{word[-3:]}>"}
    return [digest(g.encode("utf-8", "replace"), 7) % size for g in grams]


class Adam:
    """Adam on named arrays, updated in place."""

    def __init__(self, arrays: dict[str, np.ndarray], rate: float):
        self.arrays, self.rate, self.step = arrays, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in arrays.items()}
        self.v = {k: np.zeros_like(v) for k, v in arrays.items()}

    def update(self, grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.arrays[k] -= scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)

    def update_rows(self, key: str, rows: np.ndarray, g: np.ndarray) -> None:
        """Rows of a large array only (``rows`` without repeats)."""
        scale = self.rate * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step)
        m = self.m[key][rows]
        m += 0.1 * (g - m)
        v = self.v[key][rows]
        v += 0.001 * (g * g - v)
        self.m[key][rows], self.v[key][rows] = m, v
        self.arrays[key][rows] -= scale * m / (np.sqrt(v) + 1e-8)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def best_threshold(scores: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The score threshold of the best weighted F1 for label 1, in the middle
    between the neighbouring scores; 0.5 if there is only one class."""
    if len(set(y.tolist())) < 2:
        return 0.5
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], (y[order] * weight[order])
    true = np.cumsum(hit)
    f1 = 2 * true / (np.cumsum(weight[order]) + hit.sum())
    f1[np.append(s[1:] == s[:-1], False)] = -1  # equal scores fall on one side
    at = int(np.argmax(f1))
    below = s[at + 1] if at + 1 < len(s) else 0.0
    return float(np.clip((s[at] + below) / 2, 0.15, 0.85))


def move_threshold(scores: np.ndarray, found: np.ndarray | float, to: float) -> np.ndarray:
    """Scores on a new scale, in the same order: ``found`` becomes ``to``."""
    low = scores / found * to
    high = to + (scores - found) / (1 - found) * (1 - to)
    return np.clip(np.where(scores < found, low, high), 0.0, 1.0)
