"""URL rules and vocabulary against a plain reading of the contract."""

import re

import duckdb
import pytest
import regex

from sylvan.llm import urls
from sylvan.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme casino", "http://a.org", "http://a.org/", "HTTPS://WWW.Example.ORG/es/x", "http://example.org/en/1",
    "http://example.org/en/12?casino", "http://sub.example.org/EN/1", "http://notexample.org/es/", "https://x.com/fr/porn",
    "https://x.com/de/ok", "https://x.com/deutsch", "https://com/de/", "http://x.net/xxx", "http://x.net/axxx", "http://x.net/xxx1",
    "http://casino.net#top", "http://x.net/cheap-pills", "http://x.net/cheap/cheap/cheap", "http://x.net/free_win", "http://x.net/free_win/bet",
    "http://x.net/é" "xxx" "é", "http://spam-farm.net/a", "a://b://c.org/d", "http://x.net:80/p?q=poker#bet", "x://y\nz/path\nxxx", "://",
    "http://user@x.com/fr/", "http://x.net/hot/hot.cam?dating", "http://x.net/free%20casino", "http://x.net/a%2Fporn", "http://x.net/a%2fPORN%3f",
    "http://x.net/%70orn", "http://x.net/%2570orn", "http://x.net/casino%zz", "http://x.net/a%2Fporn%ff", "http://x.net/porn%ff", "http://x.net/%d0%b6xxx",
    "http://x.net/日xxx", "http://x.net/xxx٣", "http://x.net/xxx€", "http://x.net/gl%C3%BCcksspiel/gratis", "http://x.net/glücksspiel-gratis", "http://x.net/100%",
    "http://x.net%2Fporn/", "http://x.net/apuestas+ganar", "http://x.net/free+casino",
]


def slow(url, rules):
    rest = (url or "").split("://", 1)
    host = path = ""
    if len(rest) == 2:
        host = re.match(r"[^/?#]*", rest[1]).group()
        path = re.match(r"[^?#]*", rest[1][len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    raw = re.sub(rb"%([0-9a-fA-F]{2})", lambda m: bytes([int(m[1], 16)]), (url or "").encode())
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        text = url
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.name), r.verdict == "block"))
        return host, path, best.name, best.verdict
    hit = lambda t: regex.search(rf"(?<![\p{{L}}\p{{N}}]){re.escape(t)}(?![\p{{L}}\p{{N}}])", text)
    known = urls.Vocabulary.of()
    bad = any(hit(t) for t in known.strict) or sum(w for t, w in known.soft.items() if hit(t)) >= urls.SOFT_LIMIT
    return host, path, None, "block" if bad else "allow"


@pytest.mark.parametrize("rules", [URL_RULES, [*URL_RULES, urls.Rule("allow", "x.net", "/xx"), urls.Rule("block", "x.net", "/xx")]])
def test_odd_urls(spark, rules):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(None, URLS[4]), (3, URLS[3])], "page_id long, url string")
    pages = pages.selectExpr("*", "'?' as host", "'?' as rule", "'?' as id", "'?' as hits", "'?' as weight")
    got = urls.filter_urls(pages, rules).collect()
    want = [(i, *slow(u, rules)) for i, u in [*enumerate(URLS), (None, URLS[4]), (3, URLS[3])]]
    assert sorted(map(str, ((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got))) == sorted(map(str, want))


def test_hits_are_reported(spark):
    pages = spark.createDataFrame([(1, "http://x.net/xxx/free-win/free")], "page_id long, url string")
    row = urls.filter_urls(pages, URL_RULES).first()
    assert row["strict"] == ["xxx"] and row["soft"] == ["free", "win"] and row["weight"] == 2


def test_empty_table(spark):
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def test_sql_of_odd_urls(spark, tmp_path):
    """The SQL says the same of every odd url."""
    import pandas as pd

    pages = pd.DataFrame({"page_id": range(len(URLS)), "url": URLS})
    got = urls.filter_urls(spark.createDataFrame(pages.astype(object).values.tolist(), "page_id long, url string"), URL_RULES)
    mine = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect())
    con = duckdb.connect()
    con.register("pages", pages)
    assert mine == sorted(con.execute(urls.oracle_sql(URL_RULES)).fetchall())


def test_vocabulary_from_a_table(spark):
    rows = [("Foo", "en", None), ("bar", "en", 2), ("bar", "fr", 3), ("baz", "fr", 1), ("baz", "en", None), (None, "en", 1), ("", "en", None), ("été", "fr", 3)]
    table = spark.createDataFrame(rows, "term string, lang string, weight int")
    every = urls.Vocabulary.read(table)
    assert set(every.strict) == {"foo", "baz"} and every.soft == {"bar": 3, "été": 3}
    french = urls.Vocabulary.read(table, ["fr"])
    assert french.strict == () and french.soft == {"bar": 3, "baz": 1, "été": 3}
    pages = spark.createDataFrame([(1, "a://b/foo"), (2, "a://b/bar"), (3, "a://b/%C3%A9t%C3%A9"), (4, "a://b/casino"), (5, "a://b/étéx")], "page_id long, url string")
    judged = lambda v, **more: {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, [], v, **more).collect()}
    assert judged(every) == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}
    assert judged(french, soft_limit=4) == dict.fromkeys(range(1, 6), "allow")
    assert judged(urls.Vocabulary.read(table.limit(0))) == dict.fromkeys(range(1, 6), "allow")
    assert judged(urls.Vocabulary.of([]))[4] == "allow" and judged(urls.Vocabulary.of(["en"]))[4] == "block"
