"""URL filter: host and path rules, then a weighted vocabulary.

Rules name a host and a path prefix; a rule fits its host and all subdomains
where the url's path starts with the rule's path, and the longest fitting rule
decides. Urls without a rule are judged by their words: percent escapes are
decoded (once) and A-Z lower-cased, an Aho-Corasick automaton finds every
vocabulary term in one pass; a hit counts where neither neighbour is a letter or
digit of any script. One strict term rejects; so do soft terms whose weights,
each term once, reach the limit.

The vocabulary is data: ``Vocabulary.read`` takes it from a table of terms with
language and weight, ``Vocabulary.of`` picks languages of the one given here.

Corner cases: a null url, or one without ``://``, has an empty host and path
(the words of the latter still count); host and path are of the url as it
stands, not decoded, ports and user names included; escapes that are no UTF-8
leave the whole url undecoded; equally long rules that both fit: block wins.
Repeated rows are judged alike; an empty table gives an empty result, an empty
vocabulary rejects nothing.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)

#: One of these rejects a url, by language ("" for all).
STRICT_TERMS = {
    "": (
        "porn", "porno", "pornhub", "xxx", "xvideos", "hentai", "milf", "viagra", "cialis", "warez", "keygen", "malware",
        "phishing", "ransomware",
    ),
    "en": (
        "camgirl", "camgirls", "sexcam", "sexcams", "escort", "escorts", "casino", "casinos", "torrent", "torrents",
        "spam-farm", "spamfarm", "link-farm", "linkfarm",
    ),
    "de": ("pornos", "sexkontakte", "hurensex", "spielcasino", "onlinecasino"),
    "fr": ("pornographique", "camsexe", "plan-cul"),
    "es": ("pornografía", "pornografia", "putas", "casinos-online"),
}
#: Terms that only add up, with their weights.
SOFT_TERMS = {
    "en": {
        "sex": 2, "sexy": 1, "nude": 2, "adult": 1, "hot": 1, "cam": 1, "cams": 1, "dating": 1, "singles": 1,
        "bet": 1, "bets": 1, "betting": 2, "poker": 2, "slots": 1, "jackpot": 1, "bonus": 1, "free": 1, "win": 1,
        "cheap": 1, "pills": 2, "pharmacy": 1, "crack": 1, "serial": 1, "download": 1, "spam": 2, "farm": 1,
        "click": 1, "loan": 1, "loans": 1, "payday": 2, "replica": 2, "discount": 1,
    },
    "de": {
        "nackt": 2, "erotik": 2, "wetten": 1, "sportwetten": 2, "glücksspiel": 2, "gratis": 1, "billig": 1, "pillen": 2,
        "kredit": 1, "sofortkredit": 2, "gewinnen": 1,
    },
    "fr": {
        "nue": 2, "sexe": 2, "érotique": 2, "paris-sportifs": 2, "gratuit": 1, "gagner": 1, "pilules": 2, "pas-cher": 1,
        "rencontre": 1, "rencontres": 1,
    },
    "es": {
        "desnuda": 2, "sexo": 2, "erótico": 2, "apuestas": 2, "gratis": 1, "ganar": 1, "pastillas": 2, "barato": 1,
        "citas": 1, "préstamo": 1, "préstamos": 1,
    },
}
SOFT_LIMIT = 3


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms: strict ones, and soft ones with their weights."""

    strict: tuple[str, ...]
    soft: dict[str, int]

    @staticmethod
    def of(languages: Iterable[str] = tuple(SOFT_TERMS)) -> Vocabulary:
        """The terms given here, of some languages; a soft term of several
        counts with its largest weight."""
        soft: dict[str, int] = {}
        strict: list[str] = list(STRICT_TERMS[""])
        for language in languages:
            strict += STRICT_TERMS.get(language, ())
            for term, weight in SOFT_TERMS.get(language, {}).items():
                soft[term] = max(weight, soft.get(term, 0))
        return Vocabulary(tuple(dict.fromkeys(strict)), {t: w for t, w in soft.items() if t not in strict})

    @staticmethod
    def read(table: DataFrame, languages: Iterable[str] | None = None) -> Vocabulary:
        """From a table (term, lang, weight); a null weight makes a term strict.
        Null and empty terms are left out; a term that stands there more than once is strict
        if it is so anywhere, else counts with its largest weight. The terms go
        to every task: a vocabulary, not a table that grows with the pages."""
        if languages is not None:
            table = table.where(F.col("lang").isin(list(languages)))
        term = F.translate("term", UPPER, LOWER).alias("term")
        weight = F.when(F.count_if(F.col("weight").isNull()) == 0, F.max("weight")).alias("weight")
        rows = table.where(F.length("term") > 0).groupBy(term).agg(weight).orderBy("term").collect()
        return Vocabulary(
            tuple(r["term"] for r in rows if r["weight"] is None), {r["term"]: r["weight"] for r in rows if r["weight"] is not None}
        )


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str  # with its leading slash

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def words_of(url: str) -> str:
    """The url as its words are looked for: escapes decoded, A-Z lower-cased."""
    try:
        url = unquote(url, errors="strict")
    except UnicodeDecodeError:
        pass
    return url.translate(_LOWERED)


def _in_word(c: str) -> bool:
    return unicodedata.category(c)[0] in "LN"


def term_hits(vocabulary: Vocabulary):
    """A column function: url -> distinct strict and soft terms, in order."""
    held: dict = {}  # one automaton for a task

    @F.pandas_udf(T.StructType([T.StructField(k, T.ArrayType(T.StringType())) for k in ("strict", "soft")]))
    def hits(urls: pd.Series) -> pd.DataFrame:
        import ahocorasick

        if "automaton" not in held:
            automaton = ahocorasick.Automaton()
            for term in {*vocabulary.strict, *vocabulary.soft}:
                automaton.add_word(term, term)
            automaton.make_automaton()
            held.update(automaton=automaton, strict=set(vocabulary.strict))
        automaton, strict, rows = held["automaton"], held["strict"], []
        for url in urls:
            text, found = words_of(url or ""), set()
            for last, term in automaton.iter(text) if len(automaton) else ():
                first = last + 1 - len(term)
                if not (first and _in_word(text[first - 1])) and not (last + 1 < len(text) and _in_word(text[last + 1])):
                    found.add(term)
            rows.append((sorted(found & strict), sorted(found - strict)))
        return pd.DataFrame(rows, columns=["strict", "soft"])

    return hits


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    vocabulary: Vocabulary | None = None,
    soft_limit: int = SOFT_LIMIT,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (null without one),
    ``strict`` and ``soft`` (terms hit), ``weight`` of the soft terms, and
    ``verdict``."""
    vocabulary = Vocabulary.of() if vocabulary is None else vocabulary
    host, path = split_url(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    judged = rows.withColumns({"host": host, "path": path, "hits": term_hits(vocabulary)("url")})
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block"))
    first = F.coalesce(F.lit(None).cast("struct<rule:string,verdict:string>"), *[F.when(r.fits(), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ordered])
    weights = F.create_map(*[F.lit(x) for pair in vocabulary.soft.items() for x in pair])
    weight = F.aggregate("hits.soft", F.lit(0), lambda total, term: total + weights[term]) if vocabulary.soft else F.lit(0)
    judged = judged.withColumns({"of_rule": first, "weight": weight})
    own = F.when((F.size("hits.strict") > 0) | (F.col("weight") >= soft_limit), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", F.col("of_rule.rule").alias("rule"), "hits.strict", "hits.soft",
        "weight", F.coalesce("of_rule.verdict", own).alias("verdict"),
    )


def oracle_sql(rules: list[Rule]) -> str:
    """The filter in SQL with the terms given here, each by its own pattern."""
    vocabulary = Vocabulary.of()
    hit = lambda term: f"regexp_matches(u, '(^|[^\\p{{L}}\\p{{N}}]){term}([^\\p{{L}}\\p{{N}}]|$)')"
    strict = " or ".join(hit(t) for t in vocabulary.strict)
    soft = " + ".join(f"case when {hit(t)} then {w} else 0 end" for t, w in vocabulary.soft.items())
    fits = [f"((host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}'))" for r in rules]
    order = sorted(zip(rules, fits), key=lambda x: (-len(x[0].name), x[0].verdict != "block"))
    rule = "case " + " ".join(f"when {f} then '{r.name}'" for r, f in order) + " end"
    verdict = "case " + " ".join(f"when {f} then '{r.verdict}'" for r, f in order)
    verdict += f" when {strict} then 'block' when {soft} >= {SOFT_LIMIT} then 'block' else 'allow' end"
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
with parts as (
  select page_id, translate(coalesce(try(url_decode(url)), url, ''), '{UPPER}', '{LOWER}') as u,
    translate(coalesce(regexp_extract(url, '{pattern}', 1), ''), '{UPPER}', '{LOWER}') as host,
    coalesce(regexp_extract(url, '{pattern}', 2), '') as path
  from pages)
select page_id, host, path, {rule} as rule, {verdict} as verdict from parts"""
