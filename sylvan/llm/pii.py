"""Personal data: patterns with checks, and information-theoretic sanitisation
of the terms that give protected entities away. Spark SQL functions only.

Base spans: e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone
numbers, leftmost and non-overlapping for each kind; a match that fails its
check is dropped without another try. Offsets are code points. The patterns are
written so that no text makes them backtrack far: possessive quantifiers, and
a start only where a run of possible first characters starts (or where the
last match ended).

Disclosure: every base value found is a protected entity e. A term t that
stands in its documents gives it away as far as its pointwise mutual information with
it, estimated from document counts, reaches the entity's whole information:

    disclosure(t, e) = log2(N df(t, e) / (df(t) df(e))) / log2(N / df(e))

It is 1 if t occurs only with e, 0 if both are independent. From ``GENERALISE``
on the term is generalised (to a class name) in the documents that hold e, from
``REMOVE`` on it is removed there. Chance is kept out: t must stand with e in
at least ``LEAST_DOCUMENTS`` documents of different texts, so that the words of
a copied document are not held against it. Terms are runs of ``LEAST_TERM`` and
more letters and digits, anywhere in the document but inside base spans and
where they touch one. Counts cover all documents.

An entity of very many documents is never gathered into one group: its pairs
are counted with partial aggregation, and the join that brings its terms back
to its documents is an ordinary shuffled join.

Corner cases: a null or empty text has no spans; a text of any length is
searched whole; repeated rows are found alike (each counts as a document);
null ids are kept; an empty table gives an empty result. Other columns are
carried in a struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.session import Scratch

KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
# chains of fewer digits fail the check anyway, wherever they start
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: The shortest term, and the fewest different texts that hold it and the entity.
LEAST_TERM = 3
LEAST_DOCUMENTS = 3
GENERALISE, REMOVE = 0.8, 0.95
NOT_WORD = r"[^\p{L}\p{N}]+"

#: Reserved field of carried rows: a table may have no other column than its text.
ROW_MARK = "__sylvan_row"
SPAN = "struct<kind:string,start:int,stop:int,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    last_first = F.reverse(digits)

    def part(i: Column) -> Column:
        digit = F.substring(last_first, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(16, 19) & luhn(digits)


def spans_of(text: Column, kind: str, pattern: Column, passes=None, when: Column | None = None) -> Column:
    """Spans of all matches of a pattern that pass a check: the text's parts
    between the matches and the matches themselves give the offsets."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    both = F.zip_with(between, found, lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))

    def add(state: Column, match: Column) -> Column:
        start = state["at"] + match["gap"]
        stop = start + F.length(match["value"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), match["value"].alias("value"))
        return F.struct(stop.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    spans = F.aggregate(both, begin, add, lambda state: state["spans"])
    if passes is not None:
        spans = F.filter(spans, lambda s: passes(s["value"]))
    any_match = text.rlike(pattern) if when is None else when & F.regexp_like(text, pattern)
    return F.when(any_match, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """All base spans, by kind as listed, then by start."""
    ip_part = f"^{IP_PART}(?:\\.{IP_PART}){{3}}$"
    n_digits = lambda v: F.length(_digits(v))
    return F.concat(
        spans_of(text, "email", F.lit(EMAIL), when=text.contains("@")),
        spans_of(text, "ip", F.lit(IP), lambda v: v.rlike(ip_part), when=text.contains(".")),
        spans_of(text, "card", F.lit(CARD), _is_card, when=F.lit(True)),
        spans_of(text, "phone", F.lit(PHONE), lambda v: n_digits(v).between(8, 15), when=text.contains("+")),
    )


def entity(span: Column) -> Column:
    """The protected value of a span: digits only, but for e-mail addresses."""
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"])
    return F.concat(span["kind"], F.lit(":"), F.coalesce(value, _digits(span["value"])))


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), NOT_WORD), lambda w: F.length(w) >= LEAST_TERM))


def outside(text: Column, base: Column) -> Column:
    """The text without its base spans and the words that touch them."""
    ordered = F.array_sort(F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))

    def cut(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.concat(state["gaps"], F.array(gap)).alias("gaps"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("gaps"))
    gaps = F.aggregate(
        ordered, begin, cut,
        lambda state: F.concat(state["gaps"], F.array(F.substring(text, state["at"] + 1, F.length(text)))),
    )
    last = F.size(base)

    def trim(gap: Column, i: Column) -> Column:
        gap = F.when(i > 0, F.regexp_replace(gap, r"^[\p{L}\p{N}@._%+-]++", "")).otherwise(gap)
        return F.when(i < last, F.regexp_replace(gap, r"(?<![\p{L}\p{N}@._%+-])[\p{L}\p{N}@._%+-]++\z", "")).otherwise(gap)

    return F.array_join(F.transform(gaps, trim), " ")


def shared_terms(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(entity, term, df_et) of the pairs that stand together in at least
    ``LEAST_DOCUMENTS`` different texts, ``df_et`` counting copies as well."""
    text_key = (F.xxhash64("text"), F.length("text"))
    copies = found.groupBy(*text_key).agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies")).select("rid", "copies")
    texts = scratch.save(
        found.select("rid", F.array_distinct(F.transform("base", entity)).alias("entities")).join(copies, "rid"), "texts"
    )
    # only an entity of so many texts can have such a pair
    each = texts.select("rid", "copies", F.explode("entities").alias("entity"))
    known = each.groupBy("entity").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= LEAST_DOCUMENTS)
    of_text = each.join(known, "entity", "left_semi").groupBy("rid", "copies").agg(F.collect_list("entity").alias("entities"))
    words = found.select("rid", terms_of(outside(F.col("text"), F.col("base"))).alias("terms"))
    pairs = of_text.join(words, "rid").select("copies", F.explode("entities").alias("entity"), "terms")
    return (
        pairs.select("copies", "entity", F.explode("terms").alias("term"))
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("df_et"))
        .where(F.col("texts") >= LEAST_DOCUMENTS).drop("texts")
    )


def disclosures(found: DataFrame, documents: DataFrame, total: int, scratch: Scratch) -> DataFrame:
    """(entity, term, disclosure) of the terms to be generalised or removed.
    ``found``: rows with base spans; ``documents``: all rows (text)."""
    candidates = scratch.save(shared_terms(found, scratch), "candidates")
    # all terms are counted first: a common word is one row for each task by
    # then (Spark would move a semi join on the candidates below the count)
    df_t = documents.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    df_e = (
        found.select("rid", F.explode(F.array_distinct(F.transform("base", entity))).alias("entity"))
        .groupBy("entity").agg(F.count(F.lit(1)).alias("df_e"))
    )
    mutual = F.log2(F.lit(float(total)) * F.col("df_et") / (F.col("df_t") * F.col("df_e")))
    own = F.log2(F.lit(float(total)) / F.col("df_e"))
    share = F.when(own > 0, mutual / own)  # an entity in every document cannot be given away
    scored = candidates.join(df_t, "term").join(df_e, "entity").withColumn("disclosure", share)
    return scored.where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure")


def standing_terms(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(rid, term, disclosure): the disclosing terms of a document's entities
    that stand in the document itself, each with its worst disclosure. Pairs are
    made from a document's own entities and words and then looked up, so an
    entity of many documents and many terms makes no more rows than stand
    together."""
    telling = terms.select("entity").distinct()
    each = found.select("rid", F.explode(F.array_distinct(F.transform("base", entity))).alias("entity")).join(telling, "entity", "left_semi")
    of_text = each.groupBy("rid").agg(F.collect_list("entity").alias("entities"))
    words = found.select("rid", terms_of(F.col("text")).alias("words"))
    pairs = of_text.join(words, "rid").select("rid", F.explode("entities").alias("entity"), "words")
    pairs = pairs.select("rid", "entity", F.explode("words").alias("term"))
    return pairs.join(terms, ["entity", "term"]).groupBy("rid", "term").agg(F.max("disclosure").alias("disclosure"))


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (its columns but for the text), ``source`` (the text as
    it was), ``text`` (empty for null), ``base`` (spans of the four kinds) and
    ``added`` (spans of kind ``term``, whose value is ``generalise`` or
    ``remove``); both are arrays of (kind, start, stop, value)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others, F.lit(1).alias(ROW_MARK)).alias("row"), F.col(f"`{text_col}`").alias("source"))
    spans = base_spans(F.coalesce("source", F.lit("")))
    written = scratch.save(rows.withColumn("base", spans).withColumn("rid", F.monotonically_increasing_id()), "marked")
    marked = written.withColumn("text", F.coalesce("source", F.lit("")))
    found = marked.where(F.size("base") > 0)
    total = marked.count()
    terms = scratch.save(disclosures(found, marked, total, scratch), "terms")
    # no more of them than the document has words
    of_row = standing_terms(found, terms).groupBy("rid").agg(F.collect_list(F.struct("term", "disclosure")).alias("terms"))
    no_span = F.array().cast(f"array<{SPAN}>")
    joined = found.join(of_row, "rid", "left")
    listed = F.array_join(F.transform(F.array_sort("terms"), lambda t: t["term"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), listed, F.lit(r")(?![\p{L}\p{N}])"))
    hits = spans_of(F.col("text"), "term", F.coalesce(pattern, F.lit("$.")), when=F.col("terms").isNotNull())
    clear = F.filter(hits, lambda s: ~F.exists("base", lambda b: (s["start"] < b["stop"]) & (s["stop"] > b["start"])))

    def action(span: Column) -> Column:
        removed = F.exists("terms", lambda t: (t["term"] == F.lower(span["value"])) & (t["disclosure"] >= REMOVE))
        return F.struct(
            span["kind"].alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"),
            F.when(removed, "remove").otherwise("generalise").alias("value"),
        )

    with_terms = joined.withColumn("added", F.transform(clear, action)).select("row", "source", "text", "base", "added")
    without = marked.where(F.size("base") == 0).select("row", "source", "text", "base", no_span.alias("added"))
    return with_terms.unionByName(without)


def digest(spans: Column) -> Column:
    """kind:start:stop of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def sanitised(text: Column, base: Column, added: Column) -> Column:
    """The text with its spans replaced: base spans by their kind, generalised
    terms by a class name, removed ones by nothing. Of overlapping spans the
    first stands for all of them."""
    whole = lambda s: F.substring(text, s["start"] + 1, s["stop"] - s["start"])
    general = lambda s: F.when(whole(s).rlike(r"^\p{Lu}"), "[NAME]").when(whole(s).rlike(r"\p{N}"), "[NUMBER]").otherwise("[TERM]")
    by = lambda s: (
        F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        .when(s["value"] == "remove", "").otherwise(general(s))
    )
    ordered = F.array_sort(
        F.transform(F.concat(base, added), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), by(s).alias("by")))
    )

    def put(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.array(gap, s["by"]))).otherwise(state["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        ordered, begin, put,
        lambda state: F.concat(F.array_join(state["out"], ""), F.substring(text, state["at"] + 1, F.length(text))),
    )
    return F.when(F.size(base) + F.size(added) > 0, done).otherwise(text)


def sanitise_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows with personal data replaced in the text (a null text stays
    null) and its length renewed, where there is such a column."""
    found = find_personal_data(docs, text_col)
    new = F.when(F.col("source").isNotNull(), sanitised(F.col("text"), F.col("base"), F.col("added")))
    changed = found.withColumn("new_text", new)
    renewed = {text_col: F.col("new_text")}
    if length_col in docs.columns:
        longer = F.length("new_text").cast(docs.schema[length_col].dataType)
        untouched = F.size("base") + F.size("added") == 0
        renewed[length_col] = F.when(untouched, F.col(f"row.`{length_col}`")).otherwise(longer)
    return changed.select(*[renewed[c].alias(c) if c in renewed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
