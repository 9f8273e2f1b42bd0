import random

from pyspark.sql import functions as F

from homeledger.llm import warc


def test_canonical_url(frame):
    cases = {"http://WWW.A.org:80/x/?utm_source=f&b=2&a=1#t": "a.org/x?a=1&b=2", "https://a.org": "a.org", "https://a.org/?ref=x": "a.org",
             "https://a.org/x//": "a.org/x", "nothing": None, "": None, None: None, "http://a.org?reference=1": "a.org?reference=1"}
    df = frame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in df.select("u", warc.canonical_url(F.col("u"))).collect()} == cases


def capture(i, url, at, kind, headers, body=None):
    return i, url, at, kind, headers, body


SCHEMA = "capture_id long, url string, at long, kind string, headers map<string,string>, body_sha256 string"


def test_latest_earlier_response_is_taken_whatever_the_slices(frame):
    rng = random.Random(8)
    rows = [(i, f"http://a.org/{0 if rng.random() < .4 else rng.randrange(30)}", rng.randrange(500), rng.choice(["response", "revisit", "revisit"]),
             {"ETag": '"x"'}, str(i)) for i in range(900)]
    rows += [(5000, None, 3, "revisit", {}, None), (5001, "http://a.org/0", None, "revisit", None, None), (5002, "http://a.org/0", 100, None, None, "z")]
    want = {}
    for i, u, t, k, _, _ in rows:
        if k == "revisit":
            earlier = [(b, j) for j, v, b, m, _, _ in rows if m == "response" and u and t is not None and v == u and (b, j) < (t, i)]
            want[i] = max(earlier)[1] if earlier else None
    for slices in (1, 7, 1024):
        got = {r["capture_id"]: r for r in warc.resolve_revisits(frame(rows, SCHEMA), slices).collect()}
        assert len(got) == len(rows)
        assert {i: got[i]["from_id"] for i in want} == want
        assert all(got[i]["status"] == ("missing" if w is None else "etag") for i, w in want.items())
        assert all(got[i]["body_sha256"] == (None if w is None else str(w)) for i, w in want.items())


def test_validators_and_headers(frame):
    full = {"ETag": '"a"', "Last-Modified": "m", "Content-Type": "text/html", "Age": "1", "Server": "s"}
    rows = [
        capture(1, "http://a.org/1", 1, "response", full, "b1"),
        capture(2, "http://www.a.org/1/", 2, "revisit", {"etag": 'W/"a"', "age": "9", "content-type": "x", "Connection": "close", "X-New": "n"}),
        capture(3, "http://a.org/1", 3, "revisit", {"ETAG": '"b"', "Last-Modified": "m"}),
        capture(4, "http://a.org/1", 4, "revisit", {"last-modified": "m"}),
        capture(5, "http://a.org/1", 5, "revisit", {"last-modified": "other"}),
        capture(6, "http://a.org/1", 6, "revisit", {"date": "d"}),
        capture(7, "http://a.org/1", 7, "revisit", None)]
    got = {r["capture_id"]: r for r in warc.resolve_revisits(frame(rows + rows[-1:], SCHEMA)).collect()}
    assert {i: r["status"] for i, r in got.items()} == {
        1: "full", 2: "etag", 3: "mismatch", 4: "last-modified", 5: "mismatch", 6: "unverified", 7: "unverified"}
    assert got[2]["headers"] == {"age": "9", "content-type": "text/html", "etag": '"a"', "last-modified": "m", "server": "s", "x-new": "n"}
    assert got[2]["body_sha256"] == "b1" and got[3]["headers"] is None and got[3]["from_id"] == 1


def test_records(frame):
    head = "WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Target-URI:  http://a.org/?q=a:b \r\nWARC-Date: 2024-01-02T03:04:05Z\r\n"
    rows = [(1, head + "WARC-Profile: http://x/server-not-modified", "HTTP/1.1 304 Not Modified\r\nETag: \"a:b\"\nETag: \"c\"\r\n: x", None),
            (2, head + "WARC-Profile: http://x/identical-payload-digest", None, "é"), (3, None, "", ""), (4, "WARC-Date: soon", "x", None)]
    got = {r["capture_id"]: r for r in warc.read_records(frame(rows, "record_id long, warc string, http string, body string")).collect()}
    assert (got[1]["url"], got[1]["at"], got[1]["kind"], got[1]["headers"]) == ("http://a.org/?q=a:b", 1704164645, "revisit", {"etag": '"a:b"'})
    assert got[2]["kind"] == "other" and got[2]["headers"] == {} and len(got[2]["body_sha256"]) == 64
    assert got[3]["kind"] is None and got[4]["at"] is None


def test_empty_table(frame):
    assert warc.resolve_revisits(frame([], SCHEMA)).collect() == []


def test_only_complete_responses_are_sources(frame):
    def record(i, kind, status, tag, body=None, more=""):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://a.org/x\r\nWARC-Date: 2024-01-02T03:04:{i:02d}Z\r\n{more}"
        if kind == "revisit":
            head += "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified"
        return i, head, f"HTTP/1.1 {status}\r\nETag: {tag}", body

    rows = [record(1, "response", "200 OK", "a", "whole"), record(2, "response", "503 Service Unavailable", "b", "sorry"),
            record(3, "response", "206 Partial Content", "a", "wh"), record(4, "response", "304 Not Modified", "a"),
            record(5, "response", "200 OK", "a", "who", "WARC-Truncated: length\r\n"), (6, rows_without_status(6), "ETag: a", "?"),
            record(7, "revisit", "304 Not Modified", "a"), record(8, "response", "200", "c", "new"), record(9, "revisit", "304 Not Modified", "c")]
    schema = "record_id long, warc string, http string, body string"
    got = {r["capture_id"]: r for r in warc.resolve_revisits(warc.read_records(frame(rows, schema))).collect()}
    assert len(got) == 9
    assert {i: (got[i]["status"], got[i]["from_id"]) for i in (7, 9)} == {7: ("etag", 1), 9: ("etag", 8)}
    assert got[7]["body_sha256"] == got[1]["body_sha256"] and got[9]["body_sha256"] == got[8]["body_sha256"]


def rows_without_status(at):
    return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: http://a.org/x\r\nWARC-Date: 2024-01-02T03:04:{at:02d}Z"


def test_repeated_fields_are_joined(frame):
    block = "HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nVary: x\r\nset-cookie: b=2, c\r\nVARY: y\r\nETag: \"1\"\r\nETag: \"2\"\r\nEmpty:"
    got = frame([(block,), ("",)], "b string").select(warc.header_fields(F.col("b"))).collect()
    assert got[0][0] == {"set-cookie": "a=1\nb=2, c", "vary": "x, y", "etag": '"1"', "empty": ""} and got[1][0] == {}


def test_dates_with_fractions(frame):
    cases = {"2024-01-02T03:04:05Z": 1704164645, "2024-01-02T03:04:05.5Z": 1704164645, "2024-01-02T03:04:05.123456789Z": 1704164645,
             "2024-01-02T03:04Z": 1704164640, "2024-01-02": 1704153600, "soon": None, None: None}
    df = frame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", warc.record_time(F.col("t"))).collect()} == cases


def test_many_fields_take_little_longer(frame):
    import time

    def seconds(n):
        block = "\r\n".join(f"X-Field-{i}: {i}" for i in range(n))
        df = frame([(block,)], "b string").crossJoin(frame([(i,) for i in range(2000)], "i int")).select(warc.header_fields(F.col("b")).alias("m"))
        best = []
        for _ in range(2):
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(5)
    assert seconds(80) <= 12 * seconds(20) + 1
