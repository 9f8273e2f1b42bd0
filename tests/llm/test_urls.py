import re

from pyspark.sql import functions as F

from homeledger.llm import urls
from homeledger.llm.queries import URL_RULES


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", rest).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.Example.ORG/es/1?x=1#y", "https://example.org/en/12", "http://org/", "http://xorg/", "http://a.org", "http://b.com/fr/1",
        "http://b.com/de/", "http://com/de/x", "ftp://u:p@h.com:80/de/é?a=/fr/", "no scheme", "", None, "://", "a://b://c/d", "http://É.com/fr/",
        "http://x.net/#://y.org/", "http://x.org?/es/", "http:///p", "http://x.org/\n/es", "http://" + "a." * 3000 + "org/" + "p/" * 3000]


def test_hosts_paths_and_listed_rules(frame):
    df = frame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(df, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = cut(u)
        assert (got[i]["host"], got[i]["path"]) == (host, path), u
        assert got[i]["rule"] == rule(host, path)[0], u
        assert got[i]["verdict"] in ([rule(host, path)[1]] if rule(host, path)[1] else ["allow", "block"]), u
        assert host or got[i]["verdict"] == "allow"


def test_tokens(frame):
    df = frame([("HTTP://Blog.A.example.Net/en/12.html?b=1&a=2&a=3#f",), ("http://localhost",), (None,)], "url string")
    got = [r[0] for r in df.select(urls.url_tokens(F.col("url"))).collect()]
    assert got[0] == ["scheme=http", "tld=net", "site=example.net", "sub=blog.a", "dir=en", "next=1", "depth=2", "ext=html", "keys=a&b", "mark=#"]
    assert got[1] == ["scheme=http", "tld=localhost", "depth=0"] and got[2] == []


def test_mined_rules_decide_what_no_rule_fits(frame):
    rows = [(i, f"http://h{i % 5}.example.org/es/{i}.html") for i in range(60)]  # blocked by a rule
    rows += [(100 + i, f"http://h{i % 5}.example.org/en/{20 + i}") for i in range(60)]  # allowed by a rule
    rows += [(200, "http://other.net/es/1.html"), (201, "http://other.net/xx/5"), (202, "http://other.net/en/3")]
    df = frame([(*r, "c") for r in rows + rows[-3:]], "page_id long, url string, tokens string")
    got = [(r["page_id"], r["verdict"], r["confidence"]) for r in urls.judge(df, URL_RULES).collect() if r["page_id"] >= 200]
    assert sorted((k, v) for k, v, _ in got) == sorted([(200, "block"), (201, "allow"), (202, "allow")] * 2)
    assert all(c >= 0.9 for k, _, c in got if k == 200)


def test_rules_are_pruned_and_exact(frame):
    rows = [(["a=1", "b=1"], "block")] * 10 + [(["a=1", "c=1"], "allow")] * 10 + [(["b=1"], "block")] * 5
    got = {(tuple(r["items"]), r["label"]): (r["hits"], r["confidence"])
           for r in urls.mine_rules(frame(rows, "tokens array<string>, label string"), 0.1, 0.9).collect()}
    assert got == {(("b=1",), "block"): (15, 1.0), (("c=1",), "allow"): (10, 1.0)}


def test_empty_table_and_native_plan(frame):
    df = frame([], "page_id long, url string")
    out = urls.judge(df, URL_RULES)
    assert out.collect() == []
    assert not any(w in out._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))
