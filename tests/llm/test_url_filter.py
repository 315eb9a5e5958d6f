"""URL filter against regular expressions written from the globs, and its rows with odd input."""
import random
import re

import pytest

from riskline.llm import url_filter as U


def as_regex(glob):
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**", i):
            out += r"[\s\S]*"
            i += 2
            while i < len(glob) and glob[i] == "*":
                i += 1
        elif glob[i] == "*":
            out += "[^/?]*"
            i += 1
        elif glob[i] == "?":
            out += "[^/?]"
            i += 1
        elif glob[i] == "\\" and i + 1 < len(glob):
            out += re.escape(glob[i + 1])
            i += 2
        else:
            out += re.escape(glob[i])
            i += 1
    return re.compile(out)


def test_automaton_against_regular_expressions():
    r = random.Random(5)
    pieces = ["a", "b", "ab", "é", "/", "*", "**", "?", "\\?", "\\*", "."]
    globs = ["", "*", "**", "a" * 130, "a" * 63 + "*b", "*" + "b" * 64] + [
        "".join(r.choice(pieces) for _ in range(r.randint(0, 7))) for _ in range(300)]
    texts = ["", "a" * 130, "a" * 63 + "b", "x" + "b" * 64, "a" * 5000 + "/" + "b" * 5000] + [
        "".join(r.choice("aabb/?.é*𝄞\n") for _ in range(r.randint(0, 12))) for _ in range(400)]
    got = U.Automaton(globs).fits(texts)
    assert U.Automaton(globs).words > 10
    for j, g in enumerate(globs):
        form = as_regex(g)
        for i, t in enumerate(texts):
            assert got[i, j] == bool(form.fullmatch(t)), (g, t)


def by_hand(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    query = re.match(r"(\?[^#]*)?", rest[len(host) + len(path):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (verdict, h + p)
    glob = next((g for g in U.BLOCKED if as_regex(g).fullmatch(host + path + query)), None) if best is None else None
    verdict = best[0] if best else "block" if glob is not None else "allow"
    return host, path, best and best[1], glob, verdict


URLS = [
    None, "", "no scheme", "://", "http://", "http://net/", "http://NET", "http://net", "https://a.Example.NET/en/x?y#z",
    "https://example.net/EN/", "https://notexample.net/en/", "http://x.example.com/de/", "http://example.com/de", "a://b.org/fr/://c",
    "http://org/fr/", "http://evil.com/x.net/", "http://evil.com?x.net/", "http://evil.com#a.net/", "http://É.Org/fr/é", "http://my-casino.com",
    "http://my-casino.com?x", "http://x.com/casino", "http://ads.x.com/", "http://x.ads.y/z", "http://a.b/setup.exe?v=1", "http://a.b/login?next=/",
    "http://a.b/c/login", "http://a.b/?sessionid=0123456789abcdef&c", "http://a.b/?sessionid=short", "http://a.b/\nwp-login.php",
    "http://a.b/" + "x" * 60_000 + "/wp-login.php", "http://tracker.z", "http://x.example.org/fr/1", "http://x.example.org/fr/1",
]


def test_judged_against_plain_rules(spark):
    rows = [(i, u, "kept", "clash") for i, u in enumerate(URLS)] + [(None, URLS[8], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, judged string").repartition(3)
    got = U.judged(pages).select("page_id", "url", "judged.*").collect()
    assert len(got) == len(rows)
    for row in got:
        assert (row.host, row.path, row.rule, row.glob, row.verdict) == by_hand(row.url), row.url and row.url[:80]


def test_other_rules_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.b/*c"), (2, "http://a.b/xc"), (3, "http://c.d/")], "id long, link string")
    rules = [("block", "a.b", "/*"), ("allow", "a.b", "/"), ("allow", "c.d", "/"), ("block", "c.d", "/")]
    got = {r.id: (r.rule, r.verdict) for r in U.judged(pages, "link", "j", rules, ()).select("id", "j.*").collect()}
    assert got == {1: ("a.b/*", "block"), 2: ("a.b/", "allow"), 3: ("c.d/", "allow")}
    assert {r.id for r in U.judged(pages, "link", "j", (), ()).where("j.verdict = 'allow'").collect()} == {1, 2, 3}


def test_allowed_keeps_rows_and_columns(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, _url_verdict string")
    kept = U.allowed(pages)
    assert kept.columns == pages.columns
    assert {r.page_id for r in kept.collect()} == {i for i, u in enumerate(URLS) if by_hand(u)[-1] == "allow"}
    assert U.allowed(pages.limit(0)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    import __spark_entry__ as entry

    got = entry.queries()["op13_url_filter"](spark, f"/root/testdata/{sf}")
    pages = {r.page_id: r.url for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "url").collect()}
    rows = got.collect()
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"] and len(rows) == len(pages)
    for r in rows:
        host, path, rule, _, verdict = by_hand(pages[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
