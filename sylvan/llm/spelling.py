"""Spelling variants of the corpus' words: pairs at one edit, by pivotal grams.

Words are counted over all texts; a variant is an edit away (one inserted,
deleted or replaced character). A word's bigrams are ordered from rare to
common. Its *prefix* are its three rarest bigrams, and all others of the same
rank as the third; one edit touches at most two overlapping bigrams, so two
near words share one of them. Its two *pivots* are disjoint bigrams of the
prefix with the least total frequency, chosen by dynamic programming over
their positions. One edit cannot touch both. With the pivots at p < q:

- the edit stands behind the first pivot: then the other word has the same
  characters up to the end of that pivot, at the same place; or
- it stands in or before it: then the other word has the same characters from
  the second pivot on, at q, or one place further or nearer if it is longer or
  shorter by one.

Of two near words, let x be the one whose prefix ends in the rarer rank (or
either, if equal). Its surviving pivot is no commoner than that, so it lies in
the prefix of the other word as well. So the pivots of every word meet the
prefix bigrams of the others in an equi-join on (side, length, the untouched
characters with the pivot at its end): three lengths for either pivot, six rows
a word. What meets is verified by the edit distance, after a look at the sets of
letters (64 bits), of which one edit changes two at most. No pair of near words is
lost, no bucket is capped, and a common bigram makes no hot key, as the key
holds all characters on the untouched side.

The form of a word is its most frequent near word if that is at least twice as
frequent; the root is where the forms lead. Frequencies double along a chain,
so its length is at most the logarithm of the highest count, and pointer
jumping needs a known number of rounds.

The rank table holds a row per bigram of the words' letters: ``[a-zÀ-ÿ]`` and
the upper-case letters above U+00C0 that are left as they are make at most
90 * 90 = 8,100 bigrams, whatever the corpus; it is the only table broadcast.

Corner cases: null and empty texts have no words; a null id counts as the empty
text in the noise rule; repeated rows count again; a table without words gives
no rows; other columns are not read; words of fewer than five characters or
three occurrences are left out (parameters).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import Scratch

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent as its word.
FORM_RATIO = 2
#: Bigrams of the prefix: one edit touches at most two.
PREFIX_GRAMS = 3


def noisy(run: Column, doc_id: Column, one_in: int = 97) -> Column:
    """Of every ``one_in``-th run (by the CRC-32 of ``<id>:<run>``) one
    character is left out."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int | None = None,
    least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``least_chars``
    characters and ``least_count`` occurrences in all texts."""
    if least_chars < 4:
        raise ValueError("words need at least 4 characters to hold two disjoint bigrams")
    runs = docs.select(F.col(id_col).alias("_id"), F.explode(F.regexp_extract_all(text_col, F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")))
    word = F.col("run") if noise is None else noisy(F.col("run"), F.col("_id"), noise)
    # noise takes at most one character
    long = runs.where(F.length("run") >= least_chars).select(word.alias("word")).where(F.length("word") >= least_chars)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _least_pair(grams: Column) -> Column:
    """The two disjoint bigrams of least total frequency among ``grams``, an
    array of (at, df) by position. Dynamic programming from left to right:
    ``one`` is the best bigram that ends before the last one starts, ``last``
    the last one, ``pair`` the best pair so far."""
    single = "cast(null as struct<df:bigint,at:int>)"
    start = F.expr(f"struct({single} as one, {single} as last, cast(null as struct<df:bigint,first:int,second:int>) as pair)")

    def step(state: Column, gram: Column) -> Column:
        one, last = state["one"], state["last"]
        settled = F.least(one, last)  # least() passes nulls over
        # the last bigram overlaps with this one if it starts right before it
        partner = F.when(last["at"] <= gram["at"] - 2, settled).otherwise(one)
        pair = F.when(
            partner.isNotNull(),
            F.struct((partner["df"] + gram["df"]).alias("df"), partner["at"].alias("first"), gram["at"].alias("second")),
        )
        own = F.struct(gram["df"].alias("df"), gram["at"].alias("at"))
        return F.struct(settled.alias("one"), own.alias("last"), F.least(state["pair"], pair).alias("pair"))

    return F.aggregate(grams, start, step, lambda s: s["pair"])


def near_pairs(words: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b), a < b: all pairs of ``words`` (column word; distinct, of at least
    four characters, so that every prefix holds two disjoint bigrams) that
    differ by one inserted, deleted or replaced character."""
    length = F.length("word")
    spots = F.transform(F.sequence(F.lit(1), length - 1), lambda i: F.struct(i.alias("at"), F.substring(F.col("word"), i, F.lit(2)).alias("gram")))
    grams = words.select("word", F.explode(spots).alias("g")).select("word", "g.at", "g.gram")
    ranks = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranks = scratch.save(ranks, "ranks")
    # at most 8,100 rows: bigrams of the letters that words are made of
    known = grams.join(F.broadcast(ranks), "gram")
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)
    listed = known.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("df", "gram", "at"))).alias("g"), F.bit_or(bit(F.col("gram"))).alias("letters")
    )
    listed = listed.withColumn("letters", F.col("letters").bitwiseOR(bit(F.substring("word", -1, 1))))
    last = F.element_at("g", PREFIX_GRAMS)
    inside = lambda x: F.struct(x["df"].alias("df"), x["gram"].alias("gram")) <= F.col("last")
    listed = listed.withColumn("last", F.struct(last["df"].alias("df"), last["gram"].alias("gram")))
    prefix = F.transform(F.filter("g", inside), lambda x: F.struct(x["at"].alias("at"), x["df"].alias("df")))
    listed = listed.select("word", "letters", "last", F.sort_array(prefix).alias("prefix"))
    listed = scratch.save(listed.withColumn("pair", _least_pair(F.col("prefix"))), "grams")

    def key(side: str, word: Column, at: Column) -> Column:
        """The untouched characters, the bigram at ``at`` (from 1) included."""
        return F.substring(word, F.lit(1), at + 1) if side == "before" else F.substring(word, at, F.length(word))

    word = F.col("word")
    index = listed.select("word", "letters", "last", F.explode("prefix.at").alias("at"))
    index = index.select("word", "letters", "last", length.alias("length"), F.explode(F.array(
        F.struct(F.lit("before").alias("side"), key("before", word, F.col("at")).alias("part")),
        F.struct(F.lit("behind").alias("side"), key("behind", word, F.col("at")).alias("part")),
    )).alias("k"))
    probes = listed.select("word", "letters", "last", F.explode(F.array(*[
        F.struct(F.lit(side).alias("side"), key(side, word, at).alias("part"), (length + d).alias("length"))
        for side, at in (("before", F.col("pair.first")), ("behind", F.col("pair.second"))) for d in (-1, 0, 1)
    ])).alias("k"))
    x = probes.select(F.col("word").alias("x"), F.col("last").alias("x_last"), F.col("letters").alias("x_letters"), "k.side", "k.part", "k.length")
    y = index.select(F.col("word").alias("y"), F.col("last").alias("y_last"), F.col("letters").alias("y_letters"), "k.side", "k.part", "length")
    # one edit brings in or takes away two letters at most
    alike = F.bit_count(F.col("x_letters").bitwiseXOR(F.col("y_letters"))) <= 2
    met = x.join(y, ["side", "part", "length"]).where(alike & (F.col("x") != F.col("y")) & (F.col("x_last") <= F.col("y_last")))
    near = met.where(F.levenshtein("x", "y", 1) == 1)
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def spelling_forms(words: DataFrame, scratch: Scratch, ratio: int = FORM_RATIO) -> DataFrame:
    """For every row of ``words`` (word, n; words distinct): ``n_near`` (its
    near words), ``form`` and ``form_n`` (the most frequent of them, the
    smallest in code-point order of equals, if at least ``ratio`` times as
    frequent; else null) and ``root`` (where the forms lead; the word itself
    without one)."""
    words = scratch.save(words.select("word", "n"), "words")
    pairs = scratch.save(near_pairs(words, scratch), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w"))).alias("best"))
    found = words.join(best, "word", "left")
    is_form = -F.col("best.m") >= ratio * F.col("n")
    found = found.select(
        "word", F.when(is_form, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    found = scratch.save(found, "forms")
    # counts grow by the ratio along a chain of forms
    most = found.agg(F.max("n")).first()[0] or 1
    links = max(1, math.ceil(math.log(most, ratio)))
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    for k in range(math.ceil(math.log2(links)) if links > 1 else 0):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = scratch.save(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"roots{k}")
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
