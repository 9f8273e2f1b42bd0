import base64
import hashlib
import json
import re

from homeledger.llm import secrets


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, b"".join(integer(x) for x in (0, 3 ** 200, 65537, 5 ** 150, 7 ** 90, 11 ** 80, 13 ** 70, 17 ** 60, 19 ** 50)))
PKCS8 = der(0x30, integer(0) + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, b"\x04\x20" + bytes(range(32))))
EC = der(0x30, integer(1) + der(4, bytes(range(1, 33))))


def part(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()


def base_by_hand(text):
    found = []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        found += [("assign", *m.span())] * (len(m[1]) >= 6)
    found += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_forms():
    key = "AKIA" + "A1" * 8
    for text in ('PassWord = "abc123"', "token:abc", "secret:token: abcdefgh", "api_key='x.y-z_1='", "apikey=" + "q" * 300, key, key[:-1],
                 "AKIAAKIA" + "B" * 30, "0" * 24, "0" * 23, "x" + "ab" * 20 + "g", "ſecret=abcdefgh", "é token=" + "f" * 40, ""):
        assert secrets.ordered(secrets.base_spans(text)) == base_by_hand(text), text


def test_keys_are_confirmed_by_their_structure():
    for data in (RSA, PKCS8, EC, secrets.OPENSSH + b"\x00\x00\x00\x04none" * 2 + b"\x00" * 40):
        text = base64.b64encode(data).decode()
        if len(text) < 40:
            continue
        assert ("key", 4, 4 + len(text)) in secrets.all_spans(f"key {text} end"), data[:8]
        lines = "\n".join(text[i:i + 64] for i in range(0, len(text), 64))
        assert ("key", 0, len(lines)) in secrets.all_spans(lines + "\n-----END")
        assert ("key", 1, 1 + 2 * len(data)) in secrets.all_spans("(" + data.hex() + ")")


def test_other_data_is_not_reported():
    wrong = [RSA[:-1], RSA + b"\x00", der(0x30, integer(0) + integer(5)), b"\x30\x82" + b"\x00" * 80, bytes(range(90)), b"word " * 20]
    for data in wrong:
        assert not [s for s in secrets.all_spans(base64.b64encode(data).decode()) if s[0] == "key"]
        assert not [s for s in secrets.all_spans(data.hex()) if s[0] == "key"]


def test_signed_tokens():
    good = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    assert ("jwt", 2, 2 + len(good)) in secrets.all_spans("t " + good)
    for bad in (f"{part({'typ': 'JWT'})}.{part({'sub': '1'})}.abc", f"{part({'alg': 'HS256'})}.notjson.abc", f"{part(['alg'])}.{part({})}.x"):
        assert not [s for s in secrets.all_spans("t " + bad) if s[0] == "jwt"]


def test_rows(frame):
    texts = {1: 'token = "' + "ab" * 20 + '" é', 2: None, 3: "", 4: "plain " * 20_000 + "password=hunter22"}
    df = frame([(k, v, 0) for k, v in texts.items()] * 2, "doc_id long, text string, spans int")
    rows = secrets.scan(df).collect()
    assert len(rows) == 8
    for r in rows:
        want = base_by_hand(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(secrets.joined(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in want) for k in ("assign", "access", "hex")]
    assert secrets.scan(df.limit(0)).collect() == []


def test_redaction(frame):
    df = frame([(1, "a token=abcdefgh b", 18, "x"), (2, None, None, "y"), (3, "clean", 5, None)], "doc_id long, text string, n_chars long, mark string")
    rows = sorted(tuple(r) for r in secrets.redacted(df).collect())
    assert rows == [(1, "a [SECRET] b", 12, "x"), (2, None, None, "y"), (3, "clean", 5, None)]
    assert secrets.redact("0123456789", [("a", 1, 4), ("b", 2, 6), ("c", 8, 9)], "*") == "0*67*9"


CONTAINER = secrets.OPENSSH + b"\x00\x00\x00\x04none" * 2 + b"\x00" * 4 + b"\x00\x00\x00\x01" + b"\x00\x00\x00\x33" + bytes(51) + b"\x00\x00\x00\x90" + bytes(range(144))


def test_keys_end_where_their_length_says():
    for data in (RSA, PKCS8, EC, CONTAINER):
        for text in (base64.b64encode(data).decode(), base64.b64encode(data).decode().rstrip("=")):
            if len(text) < 40:
                continue
            for after in ("\nNext line", "\n\nNext", "\r\nword", " end", "-----END", "", "\\n-----END", '", "x"'):
                assert ("key", 2, 2 + len(text)) in secrets.all_spans("k " + text + after), (data[:4], after)


def test_keys_in_json_and_base64url():
    for data in (RSA, PKCS8, CONTAINER):
        text = base64.b64encode(data).decode()
        lines = [text[i:i + 64] for i in range(0, len(text), 64)]
        for gap in ("\\n", "\\r\\n", "\\\\n", "\n    "):
            body = gap.join(lines)
            before = '"private_key": "-----BEGIN PRIVATE KEY-----' + gap
            assert ("key", len(before), len(before) + len(body)) in secrets.all_spans(f'{before}{body}{gap}-----END PRIVATE KEY-----{gap}"'), gap
    for k in range(20):
        data = der(0x30, integer(0) + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, bytes([0xFB, 0xEF, 0xFF]) * 10 + bytes(2 + k)))
        text = base64.urlsafe_b64encode(data).decode()
        assert "-" in text or "_" in text
        for own in (text, text.rstrip("=")):
            assert ("key", 1, 1 + len(own)) in secrets.all_spans(f'"{own}"\nnext')


def test_hex_in_other_forms():
    text = "key = 0x" + RSA.hex() + ";"
    assert ("key", 8, 8 + 2 * len(RSA)) in secrets.all_spans(text)
    pairs = ":".join(f"{b:02x}" for b in PKCS8 + b"")
    lines = "\n    ".join(":".join(pairs.split(":")[i:i + 15]) + ":" for i in range(0, len(PKCS8), 15)).rstrip(":")
    for form in (pairs, pairs.upper(), lines):
        assert ("key", 2, 2 + len(form)) in secrets.all_spans(f"( {form})"[0:2] + form + " end"), form
    assert not [s for s in secrets.all_spans("aa:" * 40 + "zz") if s[0] == "key"]


def test_key_files_encoded_again():
    pem = "-----BEGIN PRIVATE KEY-----\n" + base64.b64encode(PKCS8).decode() + "\n-----END PRIVATE KEY-----\n"
    again = base64.b64encode(pem.encode()).decode()
    assert ("key", 9, 9 + len(again)) in secrets.all_spans(f"tls.key: {again}\n")
    public = base64.b64encode(pem.replace("PRIVATE", "PUBLIC").replace(base64.b64encode(PKCS8).decode(), "A" * 60).encode()).decode()
    assert not [s for s in secrets.all_spans(public) if s[0] == "key"]


def test_long_base64_takes_linear_time():
    import random
    import time
    rng = random.Random(1)

    def seconds(lines):
        text = "\n".join("MIIE" + base64.b64encode(rng.randbytes(45)).decode() for _ in range(lines))
        start = time.perf_counter()
        secrets.all_spans(text)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(16_000) <= 40 * seconds(2000) + 2


def test_large_keys_are_read_to_their_end():
    big = der(0x30, b"".join(integer(x) for x in (0, *([3 ** 9000] * 8))))
    text = base64.b64encode(big).decode()
    lines = "\n".join(text[i:i + 64] for i in range(0, len(text), 64))
    assert len(big) > 10_000 and ("key", 3, 3 + len(lines)) in secrets.all_spans(f"x: {lines}\nend")
