"""Secrets in texts: spans by form, and spans confirmed by decoding their structure.

Base kinds are regular expressions over the whole text, leftmost and non-overlapping per
kind. Beyond them, runs of base64 or hex digits are decoded, and reported only if what they
hold parses as a key or token. A key in base64 ends where its own length says, and only so much is
decoded, so the time is linear in the text; what says it is larger than ``LARGEST`` is no key:

* ``key``: base64 or hex (also after 0x, or in pairs with colons) whose bytes are nested ASN.1 elements with lengths
  that add up, in the shape of a private key (RSA, EC or PKCS #8), or an OpenSSH key container; or a
  key file in base64 that holds one;
* ``jwt``: three base64url parts of which the first is a JSON header naming an algorithm
  and the second a JSON object.

A text without such a run costs one regular-expression pass per kind. Spans are in code
points, end exclusive. Null texts are empty; an empty text has no spans. Memory is one
Arrow batch.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from homeledger.llm.common import ddl, slices

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "key")
# fixed values: the forms asked for
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# cheap tests that hold wherever a form can match
HEX_LONG = re.compile(r"[0-9a-f]{24,}")

JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
# an encoded key begins with an ASN.1 sequence or the OpenSSH mark; before it no digit, but a literal \n or \r
KEY_START = re.compile(r"[Mb](?:(?<![A-Za-z0-9+/_-].)|(?<=\\[nr].))(?:(?<=M)[A-P]|(?<=b)3Blbn)[A-Za-z0-9+/_-]{34,}")
BREAK = r"(?:\r?\n|\r|(?:\\+[rn])+)[ \t]*"
ALPHABETS = [  # a digit, which must not follow a key, and lines of them
    (re.compile(f"[{digits}]"), re.compile(rf"[{digits}]+(?:{BREAK}[{digits}]+)*")) for digits in ("A-Za-z0-9+/", "A-Za-z0-9_-")]
BREAKS = re.compile(BREAK)
HEX_ANY = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\b0[xX]))[0-9A-Fa-f]{64,}(?![A-Za-z0-9])")
HEX_PAIRS = re.compile(r"(?<![A-Za-z0-9:])(?:[0-9A-Fa-f]{2}:\s{0,40})++(?:[0-9A-Fa-f]{2}(?![A-Za-z0-9:]))?")  # never given up once begun
NOT_HEX = re.compile(r"[:\s]+")
# "-----BEGIN" in base64: a key file that was encoded once more, as cluster secrets are
ENCODED_AGAIN = re.compile(r"(?<![A-Za-z0-9+/_-])LS0tLS1CRUdJTi[A-Za-z0-9+/]{40,}={0,2}")
LARGEST = 1 << 16  # bytes of a key; real ones have some thousand
FIRST_LOOK = 512  # characters
CUT_BREAK = 80  # a line break that the look cuts through ends the run before
SEQUENCE, INTEGER, OCTETS, OID = 0x30, 0x02, 0x04, 0x06
OPENSSH = b"openssh-key-v1\x00"

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans by form alone."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # a maximal run of 24 or more is found by either expression
    found += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return found


def elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """The ASN.1 elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            more = n & 0x7F
            if not 1 <= more <= 4 or at + more > len(data) or data[at] == 0:
                return None
            n, at = int.from_bytes(data[at:at + more], "big"), at + more
            if n < 0x80:
                return None  # a short length written long
        if at + n > len(data):
            return None
        out.append((tag, data[at:at + n]))
        at += n
    return out


def _whole(data: bytes) -> list[tuple[int, bytes]] | None:
    outer = elements(data)
    return elements(outer[0][1]) if outer and len(outer) == 1 and outer[0][0] == SEQUENCE else None


def is_private_key(data: bytes) -> bool:
    """PKCS #1 (a version and eight integers), SEC 1 (version 1 and octets) or PKCS #8
    (a version, an algorithm with an object identifier, octets), or an OpenSSH container."""
    if data.startswith(OPENSSH):
        at, fields = len(OPENSSH), 0
        while fields < 3 and at + 4 <= len(data):
            n = int.from_bytes(data[at:at + 4], "big")
            at, fields = at + 4 + n, fields + 1
        return fields == 3 and at <= len(data)
    inner = _whole(data)
    if not inner or inner[0][0] != INTEGER or len(inner[0][1]) != 1:
        return False
    version, tags = inner[0][1][0], [t for t, _ in inner]
    if tags[:9] == [INTEGER] * 9 and version in (0, 1):
        return all(v for _, v in inner[:9])
    if version == 1 and tags[1:2] == [OCTETS] and len(inner[1][1]) >= 16:
        return True
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS]:
        algorithm = elements(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == OID and len(inner[2][1]) >= 16
    return False


def _json_part(part: str) -> object:
    try:
        return json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None


def key_size(data: bytes) -> int | None:
    """Bytes of the ASN.1 element or OpenSSH container that ``data`` begins with, as far as they say."""
    if data.startswith(OPENSSH):
        at, left = len(OPENSSH), 3
        while left:
            at, left = at + 4 + int.from_bytes(data[at:at + 4], "big"), left - 1
        keys = int.from_bytes(data[at:at + 4], "big")
        at += 4
        for _ in range(keys + 1):
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at:at + 4], "big")
        return at if keys else None
    if len(data) < 6 or data[0] != SEQUENCE:
        return None
    more = data[1] & 0x7F if data[1] & 0x80 else 0
    return 2 + more + int.from_bytes(data[2:2 + more], "big") if more <= 4 and more else 2 + data[1] if not more else None


def encoded_key_end(text: str, start: int) -> int | None:
    """Where the key in base64 or base64url ends that begins at ``start``, padding included. Its own
    length says how far it goes; line breaks, also escaped ones, may stand between its digits."""
    for digit, lines in ALPHABETS:
        room, data, size = FIRST_LOOK, b"", None
        while True:  # no further than the key's own length asks for
            run = lines.match(text, start, start + room)
            if not run:
                break
            places, at = [], start  # pieces between breaks
            for gap in BREAKS.finditer(text, start, run.end()):
                places.append((at, gap.start()))
                at = gap.end()
            places.append((at, run.end()))
            body = "".join(text[a:b] for a, b in places).replace("-", "+").replace("_", "/")
            whole = body[:len(body) - (len(body) % 4 == 1)]
            data = base64.b64decode(whole + "=" * (-len(whole) % 4))
            size, cut = key_size(data), start + room < len(text) and run.end() >= start + room - CUT_BREAK
            if not cut or (size is not None and not len(data) < size <= LARGEST) or room > 3 * LARGEST:
                break
            room *= 4
        if not run:
            continue
        if size is None and data.startswith(OPENSSH):
            size = len(data)
        if size is None or size > min(len(data), LARGEST) or not is_private_key(data[:size]):
            continue
        left = -(-size * 4 // 3)
        for a, b in places:
            if left <= b - a:
                end = a + left
                break
            left -= b - a
        if digit.match(text, end):
            continue  # goes on in the same line: not this key
        padding = -size % 3
        while padding and text[end:end + 1] == "=":
            end, padding = end + 1, padding - 1
        return end
    return None


def confirmed_spans(text: str) -> list[Span]:
    """Spans whose decoded structure is a token or a key."""
    found = []
    if "eyJ" in text or "eyA" in text or "ewo" in text or "ew0" in text:  # an encoded brace begins so
        for m in JWT.finditer(text):
            header = _json_part(m[1])
            if isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(_json_part(m[2]), dict):
                found.append(("jwt", *m.span()))
    at = 0
    while m := KEY_START.search(text, at):
        end = encoded_key_end(text, m.start())
        if end:
            found.append(("key", m.start(), end))
        at = end or m.end()
    for m in HEX_ANY.finditer(text):
        if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0])):
            found.append(("key", *m.span()))
    for m in HEX_PAIRS.finditer(text):
        if m.end() - m.start() >= 95 and m[0][-1] not in ": \t\r\n" and is_private_key(bytes.fromhex(NOT_HEX.sub("", m[0]))):
            found.append(("key", *m.span()))
    for m in ENCODED_AGAIN.finditer(text):
        body = m[0].rstrip("=")
        inner = base64.b64decode(body[:len(body) - (len(body) % 4 == 1)] + "==").decode("latin-1")
        if any(kind == "key" for kind, _, _ in confirmed_spans(inner)):
            found.append(("key", *m.span()))
    return found


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def all_spans(text: str) -> list[Span]:
    return ordered(base_spans(text) + confirmed_spans(text))


def redact(text: str, spans: list[Span], mark: str) -> str:
    """``text`` with overlapping spans merged and each replaced by ``mark``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the base kinds, digest of the base spans, and all spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for value in batch.column(1).to_pylist():
                value = value or ""
                base = ordered(base_spans(value))
                rows.append((*(sum(s[0] == kind for s in base) for kind in BASE_KINDS),
                             hashlib.sha256(joined(base).encode()).hexdigest(),
                             joined(ordered(base + confirmed_spans(value)))))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, kinds)],
                names=[key, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(key, text).mapInArrow(
        run, f"{ddl(docs, key)}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redacted(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` and ``n_chars`` counted anew; null texts stay null."""
    at, counted = docs.columns.index(text), docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            same, columns = batch.column(at).to_pylist(), list(batch.columns)
            clean = [t and redact(t, all_spans(t), mark) for t in same]
            columns[at] = pa.array(clean, columns[at].type)
            if counted is not None:
                old = columns[counted].to_pylist()
                columns[counted] = pa.array([o if c == t else len(c) for o, c, t in zip(old, clean, same)], columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # whatever their names
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
