"""Base spans against Python's regular expressions; disclosure on planted terms."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sylvan.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    digits = [int(c) for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def slow_base(text):
    text = text or ""
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if passes(k, m.group())]


def odd_texts():
    yield from [
        "a@b.c_d@e.f", "x@y@z.com", "a@b c@d.e", "..@..", "a@-.-", "é@é.com a@b.cé", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.4",
        "1.2.3.4@5.6", "4111 1111 1111 1111", "4111-1111-1111-1111-", "04111111111111111 4111111111111111222",
        "+1 (917) 555-2670", "+1", "+1.......", "+12345678901234567890", "+1 2 3 4 5 6 7 8+9 8 7 6 5 4 3 2 1", "😀 a@b.co 😀 9.9.9.9",
        "a." * 6000 + "b", "a" * 100_000, "1" * 60_000, "a@" + "b." * 9000 + "c", "+" * 3000 + "1" * 3000, "7 " * 20_000,
    ]
    rnd = random.Random(2)
    for kind in ("ab@.-_ ", "0123456789. ", "41 -", "+123() .-", "é@a.1 +"):
        for _ in range(120):
            yield "".join(rnd.choice(kind) for _ in range(rnd.randrange(60)))


def test_base_spans(spark):
    texts = list(odd_texts())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = docs.select("doc_id", pii.base_spans(F.col("text")).alias("b")).collect()
    for r in rows:
        assert [(s["kind"], s["start"], s["stop"]) for s in r["b"]] == slow_base(texts[r["doc_id"]]), texts[r["doc_id"]][:80]


@pytest.fixture(scope="module")
def planted(spark):
    """An entity named near 'falconer' in different contexts; the word stands
    nowhere else. 'green' stands everywhere. A copied document repeats a rare word."""
    rnd = random.Random(6)
    words = "green river stone walk light paper window seven orange table music forest".split()
    fill = lambda: " ".join(rnd.choice(words) for _ in range(12))
    rows = [(i, f"{fill()} Falconer wrote green from jd.smith@mail.example.com {fill()} falconer") for i in range(5)]
    rows += [(10 + i, f"from {fill()} wrote") for i in range(200)]
    rows += [(300 + i, "green zebra wrote to q@w.example.org today") for i in range(8)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_disclosing_term(planted):
    rows, docs = planted
    texts = dict(rows)
    got = {r["row"]["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    assert len(got) == len(rows)
    for i, r in got.items():
        found = [texts[i][s["start"] : s["stop"]] for s in r["added"]]
        assert found == (["Falconer", "falconer"] if i < 5 else []), (i, found)
        assert all(s["value"] == "remove" for s in r["added"])


def test_sanitised_text(spark, planted):
    out = {r["doc_id"]: r for r in pii.sanitise_documents(planted[1].withColumn("n_chars", F.length("text").cast("long"))).collect()}
    assert "[EMAIL]" in out[0]["text"] and "alconer" not in out[0]["text"] and "mail.example" not in out[0]["text"]
    assert out[0]["n_chars"] == len(out[0]["text"])
    assert out[10]["text"] == dict(planted[0])[10]


def test_share_of_disclosure(spark):
    """Between the thresholds a term is generalised: 4 of its 6 documents hold
    the entity. The figures follow the formula."""
    import math

    rnd = random.Random(1)
    fill = lambda: " ".join(rnd.choice("abc def ghi jkl mno".split()) for _ in range(6))
    rows = [(i, f"{fill()} Marlowe at 10.1.2.3 {fill()}") for i in range(4)]
    rows += [(10 + i, f"{fill()} marlowe {fill()}") for i in range(2)] + [(20 + i, fill()) for i in range(194)]
    share = math.log2(200 * 4 / (6 * 4)) / math.log2(200 / 4)
    assert pii.GENERALISE <= share < pii.REMOVE
    out = {r["doc_id"]: r["text"] for r in pii.sanitise_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "[NAME] at [IP]" in out[0] and "marlowe" in out[10]


def test_odd_documents(spark, odd_docs, odd_rows, no_docs):
    got = pii.find_personal_data(odd_docs).select("row.doc_id", "base", "added").collect()
    assert sorted((str(r["doc_id"]), str([tuple(s)[:3] for s in r["base"]])) for r in got) == sorted(
        (str(i), str(slow_base(t))) for i, t in odd_rows
    )
    kept = pii.sanitise_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.collect()
    assert len(rows) == len(odd_rows) and any(r["text"] is None for r in rows)
    assert pii.find_personal_data(no_docs).count() == 0


def test_query_and_native_plan(spark):
    from sylvan.llm import queries

    sf = "/root/testdata/sf0.001"
    out = queries.op6_pii(spark, sf)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {r["doc_id"]: r for r in out.collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        base = slow_base(r["text"])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        row = got[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        assert row["spans"].startswith(joined)


def added_terms(spark, rows):
    texts = dict(rows)
    found = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r["row"]["doc_id"]: [texts[r["row"]["doc_id"]][s["start"] : s["stop"]] for s in r["added"]] for r in found}


def common_words(rnd, n):
    return " ".join(rnd.choice("green river stone walk light paper window seven orange table music forest".split()) for _ in range(n))


def test_one_signature_in_different_documents(spark):
    """Equal surroundings of an entity are no copies when the documents differ."""
    rnd = random.Random(8)
    block = f"{common_words(rnd, 20)} regards Falconer, room 4711b, jd.smith@mail.example.com {common_words(rnd, 20)}"
    rows = [(i, f"{common_words(rnd, 30)} {i} {block}") for i in range(6)]
    rows += [(10 + i, f"{common_words(rnd, 20)} regards room") for i in range(200)]
    got = added_terms(spark, rows)
    assert all(got[i] == (["Falconer", "4711b"] if i < 6 else []) for i in got), got


def test_distant_term(spark):
    """A term far from the entity in the same documents; true copies count once."""
    rnd = random.Random(9)
    rows = [(i, f"Falconer {common_words(rnd, 60)} a@b.example.org {common_words(rnd, 60)} 2217") for i in range(5)]
    rows += [(10 + i, common_words(rnd, 20)) for i in range(200)]
    rows += [(300 + i, f"zebra {common_words(random.Random(1), 60)} q@w.example.org") for i in range(8)]
    got = added_terms(spark, rows)
    assert all(got[i] == (["Falconer", "2217"] if i < 5 else []) for i in got), got


def test_terms_of_an_entity_meet_only_the_documents_they_stand_in(spark):
    """One address in many documents, each with a term of its own and one that
    all share: rows follow what stands together, not documents times terms."""
    n = 300
    span = "struct<kind:string,start:int,stop:int,value:string>"
    rows = [(i, f"shared word{i} text", [("email", 0, 5, "a@b.co")]) for i in range(n)]
    found = spark.createDataFrame(rows, f"rid long, text string, base array<{span}>")
    key = found.select(F.transform("base", pii.entity)[0].alias("e")).first()["e"]
    terms = spark.createDataFrame([(key, f"word{i}", 0.9) for i in range(n)] + [(key, "shared", 0.5)], "entity string, term string, disclosure double")
    assert found.select(F.transform("base", pii.entity)[0].alias("e")).schema["e"].dataType.simpleString() == "string"
    got = sorted(tuple(r) for r in pii.standing_terms(found, terms).collect())
    assert got == sorted([(i, f"word{i}", 0.9) for i in range(n)] + [(i, "shared", 0.5) for i in range(n)])


def test_disclosure_against_brute_force(spark):
    """Counts, mutual information and the spans added, from a plain reading."""
    import math
    import random

    rnd = random.Random(6)
    people = [(f"p{i}@mail.org", f"nickname{i}", f"town{i}") for i in range(6)]
    texts = []
    for d in range(140):
        mail, nick, town = rnd.choice(people)
        words = [rnd.choice(["river", "stone", "green", "walk"]) + str(rnd.randrange(3)) for _ in range(12)]
        if d % 2:
            words += [mail, nick] + ([town] if rnd.random() < 0.5 else [])
        elif rnd.random() < 0.3:
            words += [town]
        rnd.shuffle(words)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["row"]["doc_id"]: {(s["start"], s["stop"], s["value"]) for s in r["added"]} for r in pii.find_personal_data(docs).collect()}
    held = [set(t.lower().split()) for t in texts]
    total = len(texts)
    for d, text in enumerate(texts):
        want = set()
        mails = [m for m, _, _ in people if m in text.split()]
        for mail in mails:
            df_e = sum(mail in h for h in held)
            for term in {w for w in text.split() if "@" not in w and len(w) >= pii.LEAST_TERM}:
                both = len({t for t, h in zip(texts, held) if mail in h and term in h})
                if both < pii.LEAST_DOCUMENTS:
                    continue
                df_et = sum(mail in h and term in h for h in held)
                df_t = sum(term in h for h in held)
                share = math.log2(total * df_et / (df_t * df_e)) / math.log2(total / df_e)
                if share >= pii.GENERALISE:
                    action = "remove" if share >= pii.REMOVE else "generalise"
                    at = -1
                    padded = f" {text} "
                    while (at := padded.find(f" {term} ", at + 1)) >= 0:
                        want.add((at, at + len(term), action))
        assert got[d] == want, (d, text)
