"""Toxicity, quality and line labelling: held-out accuracy, gradients, corner cases."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import pytest

from sylvan.llm import lines, quality, toxicity, training

SF = "/root/testdata/sf0.1"


def sample(rows, marks, seed=1):
    """Documents of invented words; those of class 1 hold one of ``marks``."""
    rnd = random.Random(seed)
    syllables = "ba ko ri tu me la so ne".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 5)))
    out = []
    for i in range(rows):
        words = [word() for _ in range(rnd.randrange(5, 80))]
        if i % 2:
            words.insert(rnd.randrange(len(words)), rnd.choice(marks) + rnd.choice(["", ".", ","]))
        out.append((" ".join(words), i % 2, 1.0))
    return pd.DataFrame(out, columns=["text", "y", "weight"])


def test_convolution_learns_words_and_pairs():
    model = toxicity.train(sample(400, ["vex", "grim dork"]))
    fresh = sample(200, ["vex", "grim dork", "Vex!"], seed=2)
    scorer = toxicity.Scorer(model)
    scores = np.array([scorer.score(t) for t in fresh["text"]])
    assert ((scores >= toxicity.THRESHOLD) == (fresh["y"] == 1)).mean() > 0.95


def test_long_text_equals_its_windows():
    model = toxicity.train(sample(60, ["vex"]))
    scorer = toxicity.Scorer(model)
    words = toxicity.words_of(" ".join(sample(40, ["vex"], seed=3)["text"]))
    text = " ".join(words)
    whole = scorer.raw(text)
    held, toxicity.PART_WORDS = toxicity.PART_WORDS, 50
    try:
        assert abs(scorer.raw(text) - whole) < 1e-6
    finally:
        toxicity.PART_WORDS = held


def test_factorisation_machine_value_is_the_sum_over_pairs():
    rnd = np.random.default_rng(1)
    n = quality.BUCKETS + quality.DENSE
    model = quality.FactorModel(rnd.standard_normal(n), rnd.standard_normal((n, 4)), 0.3)
    at, x = np.array([1, 5, 9, 30]), rnd.standard_normal(4)
    pairs = sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert abs(model.value(at, x) - (0.3 + x @ model.weight[at] + pairs)) < 1e-9


def test_viterbi_is_the_best_labelling():
    rnd = np.random.default_rng(2)
    for n in (1, 2, 5, 8):
        model = lines.LineModel(rnd.standard_normal((len(lines.FEATURES), 2)), rnd.standard_normal((2, 2)))
        x = rnd.standard_normal((n, len(lines.FEATURES)))

        def value(labels, model=model, x=x):
            own = sum((x[i] @ model.weights)[a] for i, a in enumerate(labels))
            return own + sum(model.pairs[a, b] for a, b in zip(labels, labels[1:]))

        best = max(product((0, 1), repeat=n), key=value)
        assert model.viterbi(x).tolist() == list(best)


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    with_word = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(with_word) - len(set(with_word)), len(covered)
    )


def test_plain_counts():
    rnd = random.Random(3)
    for kind in ("ab \n", "a b #\n\xa0\x1c", "é 日\t|\r\n", "xy z"):
        for _ in range(100):
            text = "".join(rnd.choice(kind) for _ in range(rnd.randrange(80)))
            assert lines.plain_counts(text) == slow_counts(text)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.where((training.bucket_of("doc_id", 15) % 3 == 1) & (training.bucket_of("doc_id", 15) % 5 == 0))
    rows = docs.join(held, "doc_id")
    toxic = toxicity.fit(docs, labels)
    good = quality.fit(docs, labels)
    line = lines.fit(docs, labels)
    scored = toxicity.score_documents(rows, toxic).withColumn("quality_score", quality.score_column(good)).drop("kept")
    out = scored.join(lines.judge_lines(docs, line), "doc_id").select("toxic", "quality", "is_toxic", "quality_score", "kept", "base_failed").toPandas()
    assert len(out) > 100
    assert (out["is_toxic"] == (out["toxic"] == 1)).mean() > 0.95
    assert ((out["quality_score"] >= quality.THRESHOLD) == (out["quality"] == 1)).mean() > 0.97
    plain = out[~out["base_failed"]]
    assert (plain["kept"] == (plain["quality"] == 1)).mean() > 0.97


def test_training_rows_are_not_held_out(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(7, 1, 0)], "doc_id long, quality int, toxic int")
    got = training.labelled_sample(docs, labels, "quality", 3, 1, rows=40)
    assert got["y"].value_counts().to_dict() == {0: 40, 1: 40}
    assert all(zlib.crc32(t.split()[1].encode()) % 3 != 1 for t in got["text"])
    assert training.labelled_sample(docs, labels, "toxic", 3, 1)["y"].nunique() == 1
    again = training.labelled_sample(docs, labels, "quality", 3, 1, rows=40)
    assert got.equals(again)


@pytest.mark.parametrize("trained", [True, False])
def test_odd_documents(spark, odd_docs, odd_rows, no_docs, trained):
    rows = sample(60, ["vex"])
    toxic = toxicity.train(rows) if trained else None
    good = quality.train(rows) if trained else None
    line = lines.train(rows) if trained else None
    a = toxicity.score_documents(odd_docs.select("doc_id", "text"), toxic).collect()
    b = quality.score_documents(odd_docs.select("doc_id", "text"), good).collect()
    c = lines.judge_lines(odd_docs, line).collect()
    assert len(a) == len(b) == len(c) == len(odd_rows)
    assert all(0 <= r["toxicity"] <= 1 for r in a) and all(0 <= r["quality"] <= 1 for r in b)
    if not trained:
        assert not any(r["is_toxic"] for r in a) and all(r["is_good"] for r in b)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in c) == sorted((str(i), *slow_counts(t)) for i, t in odd_rows)
    assert not any(r["kept"] and r["base_failed"] for r in c)
    assert toxicity.score_documents(no_docs, toxic).count() == 0
    assert lines.judge_lines(no_docs, line).count() == 0


def test_no_labels_train_nothing(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(no_docs, labels) is None and quality.fit(no_docs, labels) is None and lines.fit(no_docs, labels) is None


def test_moved_threshold_keeps_order():
    scores = np.linspace(0, 1, 11)
    moved = training.move_threshold(scores, 0.4, 0.7)
    assert (np.diff(moved) > 0).all() and abs(moved[4] - 0.7) < 1e-12 and moved[0] == 0 and moved[-1] == 1


def plain_probability(model, words, buckets, out_bias):
    """The network word by word, window by window, in doubles."""
    size, n = toxicity.SIZE, toxicity.FILTERS
    rows = []
    for word in words:
        flat, _ = buckets.of(np.array([word - 1])) if word else (np.zeros(0, dtype=int), None)
        rows.append(model.table[flat].sum(axis=0) / np.sqrt(len(flat)) if word else np.zeros(size))
    pooled = []
    for w in toxicity.WIDTHS:
        padded = rows + [np.zeros(size)] * (w - 1)
        answers = [np.concatenate(padded[i : i + w]) @ model.filters[w] for i in range(len(rows))]
        pooled += [max(a[f] for a in answers) for f in range(n)]
    hidden = np.maximum(np.array(pooled) + model.bias, 0)
    return 1 / (1 + np.exp(-(hidden @ model.out + out_bias)))


def small_network(seed):
    """A network of doubles over words 1 to 6 of known buckets, and documents."""
    rnd = np.random.default_rng(seed)
    buckets = toxicity.Buckets()
    for word in range(6):
        buckets.add(sorted(rnd.choice(40, size=1 + word % 3, replace=False).tolist()))
    buckets.settle()
    draw = lambda *shape: rnd.standard_normal(shape)
    n = toxicity.FILTERS * len(toxicity.WIDTHS)
    filters = {w: draw(w * toxicity.SIZE, toxicity.FILTERS) * 0.3 for w in toxicity.WIDTHS}
    model = toxicity.ConvModel(draw(toxicity.BUCKETS + 1, toxicity.SIZE) * 0.5, filters, draw(n) * 0.1, draw(n) * 0.3, 0.0, np.full(1, 0.5))
    docs = [np.append(rnd.integers(1, 7, size), [0] * (toxicity.PAD + 1)) for size in (1, 2, 5, 9)]
    return model, buckets, docs


class Recorder:
    """In the place of the optimiser: keeps the gradients it is given."""

    def __init__(self, bias):
        self.arrays, self.grads, self.rows = {"b": np.array([bias])}, {}, {}

    def update(self, grads):
        self.grads = grads

    def update_rows(self, name, rows, grads):
        self.rows = dict(zip(rows.tolist(), grads))


@pytest.mark.parametrize("seed", [1, 2])
def test_gradients_of_the_convolution_are_those_of_a_plain_network(seed):
    model, buckets, docs = small_network(seed)
    y, adam = np.array([1.0, 0.0, 0.0, 1.0]), Recorder(0.2)
    toxicity._step(model, adam, docs, y, buckets)

    def loss(bias=0.2):
        p = np.array([plain_probability(model, d, buckets, bias) for d in docs])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    def slope(array, at, step=1e-5):
        held = array[at]
        array[at] = held + step
        up = loss()
        array[at] = held - step
        down = loss()
        array[at] = held
        return (up - down) / (2 * step)

    rnd = np.random.default_rng(seed + 10)
    arrays = {"out": model.out, "bias": model.bias} | {f"f{w}": model.filters[w] for w in toxicity.WIDTHS}
    for name, array in arrays.items():
        for i in rnd.choice(array.size, 12, replace=False):
            at = np.unravel_index(i, array.shape)
            assert abs(adam.grads[name][at] - slope(array, at)) < 2e-5, (name, at)
    assert abs(adam.grads["b"][0] - (loss(0.2 + 1e-5) - loss(0.2 - 1e-5)) / 2e-5) < 2e-5
    assert len(adam.rows) > 3
    for row, grad in adam.rows.items():
        for k in range(0, toxicity.SIZE, 5):
            assert abs(grad[k] - slope(model.table, (row, k))) < 2e-5, (row, k)


def test_scorer_is_the_plain_network():
    model = toxicity.train(sample(60, ["vex"]))
    scorer = toxicity.Scorer(model)
    for text in ["", "vex", "ba ko vex! ri", *sample(6, ["vex"], seed=4)["text"]]:
        words, buckets = toxicity.words_of(text), toxicity.Buckets()
        for word in words:
            buckets.add(toxicity.features(word))
        buckets.settle()
        numbers = [*range(1, len(words) + 1), *[0] * (toxicity.PAD + 1)]
        assert abs(plain_probability(model, numbers, buckets, model.out_bias) - scorer.raw(text)) < 1e-4, text


def test_gradient_of_the_line_model_is_that_of_all_labellings(monkeypatch):
    """Forward-backward against the likelihood summed over every labelling."""
    rnd = np.random.default_rng(6)
    seen = {}

    class Once:
        def __init__(self, arrays, rate):
            for name, array in arrays.items():
                array[:] = rnd.standard_normal(array.shape) * 0.3
            seen.update(arrays)

        def update(self, grads):
            seen["grads"] = grads

    monkeypatch.setattr(lines, "Adam", Once)
    monkeypatch.setattr(lines, "STEPS", 1)
    monkeypatch.setattr(lines, "CHAIN", 4)
    texts = ["A plain line.\nHOME | LOGIN\nAnother plain line, of words.\nA plain line.\n$$$ ### |||\nThe end.", "one\ntwo two two", "x", ""]
    good = [1, 0, 1, 0]
    lines.train(pd.DataFrame({"text": texts, "y": good, "weight": 1.0}))
    chains = []
    for text, y in zip(texts, good):
        x = lines.chain_features(lines.lines_of(text))
        labels = lines.line_labels(x, y == 1) if len(x) else []
        chains += [(x[a : a + 4], labels[a : a + 4]) for a in range(0, len(x), 4)]
    total = sum(len(x) for x, _ in chains)
    weights, pairs = seen["weights"], seen["pairs"]

    def value(x, labels):
        return sum((x @ weights)[i, a] for i, a in enumerate(labels)) + sum(pairs[a, b] for a, b in zip(labels, labels[1:]))

    def loss():
        miss = sum(np.log(sum(np.exp(value(x, z)) for z in product((0, 1), repeat=len(x)))) - value(x, y) for x, y in chains)
        return miss / total + 0.5e-4 * ((weights**2).sum() + (pairs**2).sum())

    for name, array in (("weights", weights), ("pairs", pairs)):
        for at in np.ndindex(array.shape):
            held = array[at]
            array[at] = held + 1e-5
            up = loss()
            array[at] = held - 1e-5
            down = loss()
            array[at] = held
            assert abs(seen["grads"][name][at] - (up - down) / 2e-5) < 1e-7, (name, at)


def test_toxicity_learns_from_texts_of_any_length(spark):
    """texts of more than 20,000 characters were left out of the training."""
    rows = sample(40, ["vex"])
    table = [(i, t + " " + "lorem ipsum " * 1800, int(y)) for i, (t, y) in enumerate(zip(rows["text"], rows["y"]))]
    docs = spark.createDataFrame([r[:2] for r in table], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in table], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is not None


def test_rounds_take_every_row(spark):
    rows = spark.range(6000).select(training.F.xxhash64("id").alias("h"), training.F.when(training.F.col("id") % 40 == 0, 1).otherwise(0).alias("y"))
    rounds = training.training_rounds(1_000_000, 70_000)
    assert [r.low for r in rounds[1:]] == [r.high for r in rounds[:-1]] and rounds[0].low == 0 and rounds[-1].high == 1
    counts = {0: 5850, 1: 150}
    dealt = [training.deal(rows, each, counts).toPandas() for each in rounds]
    common = pd.concat([d[d["y"] == 0] for d in dealt])
    assert len(common) == 5850 == common["h"].nunique()
    for each, d in zip(rounds, dealt):  # the rare class: all of it in every round
        assert d[d["y"] == 1]["h"].nunique() == 150 and d["shard"].nunique() == each.shards
        assert d.groupby("shard")["y"].nunique().eq(2).all()
