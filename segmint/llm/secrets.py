"""Secret scan with structural confirmation.

Three plain patterns (assignments, access keys, hex runs) give the base spans. On top of
them, base64 and hex candidates are decoded and parsed before anything is reported:
DER private keys by their nested ASN.1 lengths, OpenSSH keys by their nested
length-prefixed strings, and signed tokens by their JSON header and payload. A candidate
that does not parse to its last byte is not reported. Work is linear in the text and its spans.

Null text counts as empty and yields no spans; rows are kept one to one, so repeated rows
give repeated results; extra columns are ignored (scan) or kept (redaction).
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small_batches, text_column

#: Kinds in listing order: base patterns first, then the structurally confirmed ones.
KINDS = ("assign", "access", "hex", "pem_key", "der_key", "ssh_key", "hex_key", "signed_token")
BASE_KINDS = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a maximal run, so the same as dropping shorter matches
HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run as well
BASE64_RUN = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
HEX_ANY = re.compile(r"[0-9A-Fa-f]{24,}")  # candidates for keys: either case
#: How keys begin: the tag 0x30 of a DER sequence, or "ope" of openssh-key-v1.
HEX_STARTS, BASE64_STARTS = ("30", "6f"), ("M", "b3Bl")
LINE_BREAK = re.compile(r"[\x20\t]*(?:\r?\n|(?:\\r)?\\n)[\x20\t]*")
#: Lines of base64 of either alphabet; the structure says at which line's end a key ends.
BASE64_LINES = re.compile(rf"[A-Za-z0-9+/_-]{{16,}}(?:{LINE_BREAK.pattern}[A-Za-z0-9+/_-]+)*")
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*)PRIVATE KEY-----")

# Byte classes for a cheap first test: a long run in the translated text is searched as a literal.
_LOWER = bytes(range(256)).lower()
_HEX_CLASS = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_ANY_CLASS = bytes(120 if chr(b) in "0123456789abcdefABCDEF" else 32 for b in range(256))
_B64_ANY_CLASS = bytes(120 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_-") else 32 for b in range(256))
_B64_CLASS = bytes(
    120 if b < 128 and (chr(b).isalnum() or chr(b) in "+/") else 32 for b in range(256)
)
_SPANS = "array<struct<kind:string,start:int,end:int>>"


def _der(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, body) items of DER data whose lengths add up exactly, else None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(data):
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
        if at + n > len(data):
            return None
        items.append((tag, data[at : at + n]))
        at += n
    return items


def is_der_key(data: bytes) -> bool:
    """PKCS#1, DSA, PKCS#8 (plain or encrypted) or SEC1 private key, by nested lengths."""
    top = _der(data)
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = _der(top[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags[:1] == [0x02] and inner[0][1] == b"\x00":
        if tags in ([0x02] * 9, [0x02] * 6):  # PKCS#1: version and eight integers; DSA: version and five
            return True
        if tags[1:3] == [0x30, 0x04]:  # PKCS#8: version, algorithm, key octets
            algorithm = _der(inner[1][1])
            return bool(algorithm) and algorithm[0][0] == 0x06 and bool(_der(inner[2][1]))
    if tags[:2] == [0x02, 0x04] and inner[0][1] == b"\x01":  # SEC1
        return len(inner[1][1]) >= 20 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        algorithm = _der(inner[0][1])
        return bool(algorithm) and len(algorithm) == 2 and algorithm[0][0] == 0x06 and len(inner[1][1]) >= 16
    return False


def is_ssh_key(data: bytes) -> bool:
    """openssh-key-v1: magic, then length-prefixed strings that end with the data."""
    return _ssh_length(lambda a, b: data[a:b], len(data)) == len(data)


def _ssh_length(read: Callable[[int, int], bytes | None], size: int) -> int | None:
    """Where the strings of an OpenSSH key at the start of ``size`` bytes end. Only lengths are
    read, ``read(a, b)`` gives the bytes from a to b."""
    magic = b"openssh-key-v1\x00"
    if size < len(magic) or read(0, len(magic)) != magic:
        return None
    at = len(magic)

    def number(where: int) -> int | None:
        raw = read(where, where + 4) if where + 4 <= size else None
        return None if raw is None else int.from_bytes(raw, "big")

    def string() -> tuple[int, int] | None:
        nonlocal at
        n = number(at)
        if n is None or at + 4 + n > size:
            return None
        at += 4 + n
        return at - n, n

    if any(string() is None for _ in range(3)):
        return None
    keys = number(at)
    at += 4
    if keys is None or not 1 <= keys <= 16:
        return None
    for _ in range(keys):
        public = string()
        if public is None or public[1] < 8:
            return None
        first = number(public[0])
        if first is None or first > public[1] - 4:
            return None
    return at if string() is not None else None


def _b64(text: str, url: bool = False) -> bytes | None:
    text = text.rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    """Header is a JSON object naming its algorithm; the payload is a JSON object too."""
    try:
        header, payload = (json.loads(_b64(part, url=True) or b"") for part in text.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, dict)


def _key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der_key" if is_der_key(data) else "ssh_key" if is_ssh_key(data) else None


def _der_length(data: bytes) -> int | None:
    """The length that the header of a DER sequence at the start of the data gives."""
    if len(data) < 6 or data[0] != 0x30:
        return None
    k = data[1] & 0x7F if data[1] & 0x80 else 0
    if k > 4:
        return None
    return 2 + k + (int.from_bytes(data[2 : 2 + k], "big") if k else data[1])


def _line_keys(text: str, first: int, last: int) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of keys that begin and end with a line of text[first:last]."""
    breaks = [m.span() for m in LINE_BREAK.finditer(text, first, last)]
    starts, ends = [first, *(b for _, b in breaks)], [*(a for a, _ in breaks), last]
    lines = [text[a:b].replace("-", "+").replace("_", "/") for a, b in zip(starts, ends)]
    joined, places = "".join(lines), [0, *accumulate(map(len, lines))]
    after = 0
    for i, line in enumerate(lines):
        if i < after or not line.startswith(BASE64_STARTS):
            continue
        begin = places[i]
        if line[0] == "M":
            n = _der_length(_b64(joined[begin : begin + 8]) or b"")
        else:

            def read(a: int, b: int, begin: int = begin) -> bytes | None:
                raw = _b64(joined[begin + a // 3 * 4 : begin - (-b // 3) * 4])
                return None if raw is None else raw[a % 3 : a % 3 + b - a]

            n = _ssh_length(read, (len(joined) - begin) * 6 // 8)
        chars = 0 if n is None else (8 * n + 5) // 6
        if chars < 40:
            continue
        j = bisect_left(places, begin + chars)  # the key ends with line j - 1
        if j < len(places) and places[j] == begin + chars and (kind := _key_kind(_b64(joined[begin : places[j]]))):
            end = close = ends[j - 1]
            while end < len(text) and end < close + 2 and text[end] == "=":
                end += 1
            yield kind, starts[i], end
            after = j


class _Cover:
    """Whether a position lies in one of some spans, which come by start."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.reach: list[int] = []  # the furthest end so far

    def add(self, start: int, end: int) -> None:
        self.starts.append(start)
        self.reach.append(max(end, self.reach[-1] if self.reach else 0))

    def __contains__(self, at: int) -> bool:
        n = bisect_right(self.starts, at)
        return n > 0 and at < self.reach[n - 1]


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end) spans of a text in code points, by start, then kind."""
    spans: list[tuple[str, int, int]] = []
    raw = text.encode("utf-8", "surrogatepass")
    lower = raw.translate(_LOWER)
    if any(k in lower for k in KEYWORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    if b"x" * 24 in raw.translate(_HEX_CLASS):
        for m in HEX.finditer(text):
            spans.append(("hex", m.start(), m.end()))
            if len(m[0]) % 2 == 0 and m[0].startswith(HEX_STARTS) and _key_kind(bytes.fromhex(m[0])):
                spans.append(("hex_key", m.start(), m.end()))
    if b"x" * 24 in raw.translate(_HEX_ANY_CLASS):
        seen = set(spans)
        for m in HEX_ANY.finditer(text):
            if len(m[0]) % 2 == 0 and m[0][:2].lower() in HEX_STARTS and ("hex_key", *m.span()) not in seen and _key_kind(bytes.fromhex(m[0])):
                spans.append(("hex_key", m.start(), m.end()))
    pem = _Cover()
    if b"PRIVATE KEY-----" in raw:
        missing: set[str] = set()  # labels with no further end line: do not search again
        for m in PEM_BEGIN.finditer(text):
            if m[1] in missing:
                continue
            close = f"-----END {m[1]}PRIVATE KEY-----"
            end = text.find(close, m.end())
            if end < 0:
                missing.add(m[1])
            elif _key_kind(_b64(re.sub(r"\\[nr]|\s", "", text[m.end() : end]))):
                spans.append(("pem_key", m.start(), end + len(close)))
                pem.add(m.start(), end + len(close))
    if b"x" * 40 in raw.translate(_B64_CLASS):
        for m in BASE64_RUN.finditer(text):
            if m[0].startswith(BASE64_STARTS) and m.start() not in pem and (kind := _key_kind(_b64(m[0]))):
                spans.append((kind, m.start(), m.end()))
    if b"x" * 16 in raw.translate(_B64_ANY_CLASS):
        seen = set(spans)
        for m in BASE64_LINES.finditer(text):
            spans += [s for s in _line_keys(text, m.start(), m.end()) if s not in seen and s[1] not in pem]
    if b"eyJ" in raw:
        spans += [("signed_token", m.start(), m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each group of overlapping spans replaced by one marker."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][1] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[REDACTED:{kind}]"]
        at = end
        i += 1
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (kind, start, end)."""
    kind = df.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in small_batches(batches, text_col):
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in text_column(batch, text_col)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(found, item)], [id_col, "spans"])

    return df.select(id_col, text_col).mapInArrow(scan, f"`{id_col}` {kind}, spans {_SPANS}")


def redact_secrets(df: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced by markers and the length updated.

    A row without secrets, and a null text, come back unchanged.
    """

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            lengths = batch.column(length_col).to_pylist()
            for i, text in enumerate(texts):
                if text and (spans := find_secrets(text)):
                    texts[i] = redact(text, spans)
                    lengths[i] = len(texts[i])
            names = batch.schema.names
            columns = [
                pa.array(texts, batch.schema.field(c).type) if c == text_col
                else pa.array(lengths, batch.schema.field(c).type) if c == length_col
                else batch.column(c)
                for c in names
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(clean, df.schema)
