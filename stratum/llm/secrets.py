"""Secret scans with structural confirmation (operator 4).

Plain patterns find assignments, access ids and hexadecimal strings. On top of
them, encoded candidates are reported only when they parse: base64 or hex that
decodes to a private key (DER, PEM or OpenSSH, every nested length adding up) and
signed tokens whose header is a JSON object naming an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

Span = tuple[str, int, int]

#: The three base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "jwt", "key", "hexkey", "pem")
RANK = {k: i for i, k in enumerate(KINDS)}

_RUN = re.compile(r"[A-Za-z0-9+/_=.-]{24,}")
_ATOM = re.compile(r"[A-Za-z0-9+/_-]+(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{64,}")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,.-]*")
#: Base64 over several lines: a real line break, or the two characters that stand for it in JSON and env files.
_WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:(?:\r?\n|\\r\\n|\\n)[A-Za-z0-9+/_-]{16,})*(?:\r?\n|\\r\\n|\\n)[A-Za-z0-9+/_-]+={0,2}")
_BREAK = re.compile(r"\r?\n|\\r\\n|\\n")
_HEADER_LINE = re.compile(r"^[A-Za-z-]+:.*$", re.M)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind; matches that are too short are dropped."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def decode_base64(text: str) -> bytes | None:
    """Standard or URL-safe base64, padding optional; None when it isn't."""
    body = text.rstrip("=")
    if len(body) % 4 == 1 or len(text) - len(body) > 2 or "=" in body:
        return None
    body = body.replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def read_der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the value at ``at``; None unless its length is minimal and stays within ``end``."""
    if at + 2 > end:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        n = int.from_bytes(data[at:at + size], "big")
        if n < 0x80:
            return None
        at += size
    return (tag, at, at + n) if at + n <= end else None


def der_children(data: bytes, at: int, end: int, most: int = 16) -> list[tuple[int, int, int]] | None:
    """The values that fill [at, end) exactly, or None."""
    out = []
    while at < end:
        child = read_der(data, at, end)
        if child is None or len(out) == most:
            return None
        out.append(child)
        at = child[2]
    return out


def is_private_der(data: bytes) -> bool:
    """PKCS#1, PKCS#8 (plain or encrypted), SEC1 or DSA private key filling ``data`` exactly."""
    top = read_der(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = der_children(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]

    def algorithm(p: tuple[int, int, int]) -> bool:
        inner = der_children(data, p[1], p[2])
        return bool(inner) and inner[0][0] == 0x06

    if tags[0] == 0x30:  # encrypted PKCS#8: algorithm, octets
        return tags == [0x30, 0x04] and algorithm(parts[0])
    if tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1 or data[parts[0][1]] > 1:
        return False
    if tags[1] == 0x02:  # RSA has nine integers, DSA six
        return len(tags) in (6, 9) and set(tags) == {0x02}
    if tags[1] == 0x30:  # PKCS#8: version, algorithm, octets, optional attributes
        return len(tags) >= 3 and tags[2] == 0x04 and algorithm(parts[1]) and all(t in (0xA0, 0xA1, 0x81) for t in tags[3:])
    # SEC1: version 1, octets, optional parameters and public key
    return tags[1] == 0x04 and data[parts[0][1]] == 1 and parts[1][2] - parts[1][1] >= 16 and all(
        t in (0xA0, 0xA1) for t in tags[2:])


def is_openssh_key(data: bytes) -> bool:
    """OpenSSH private key: the magic, then length-prefixed fields that end where the data ends."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, keys = len(magic), None
    fields = 3
    while fields:
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        fields -= 1
        if fields == 0 and keys is None:
            if at + 4 > len(data):
                return False
            keys = int.from_bytes(data[at:at + 4], "big")
            if not 1 <= keys <= 16:
                return False
            at, fields = at + 4, keys + 1
    return at <= len(data) and len(data) - at < 8


def is_key(data: bytes | None, depth: int = 0) -> bool:
    """A private key in any of the parsed encodings; PEM text inside base64 is opened once."""
    if not data or len(data) < 32:
        return False
    if data[0] == 0x30:
        return is_private_der(data)
    if data.startswith(b"openssh-key-v1\0"):
        return is_openssh_key(data)
    if depth == 0 and data.startswith(b"-----BEGIN "):
        return bool(pem_spans(data.decode("latin-1")))
    return False


def pem_spans(text: str) -> list[Span]:
    """PEM private keys whose body parses. A header's foot must come before the next header, so each stretch of the
    text between two headers is searched once, whatever is missing."""
    out, at = [], 0
    while m := _PEM.search(text, at):
        at = m.end()
        following = text.find("-----BEGIN ", at)
        foot = f"-----END {m[1]}-----"
        end = text.find(foot, at, len(text) if following < 0 else following)
        if end < 0:
            continue
        inner = _BREAK.sub("\n", text[at:end])
        if not _PEM_BODY.fullmatch(inner):
            continue
        body = "".join(_HEADER_LINE.sub("", inner).split())
        data = decode_base64(body)
        # an encrypted traditional key says so in its header; its bytes cannot be parsed
        sealed = "Proc-Type:" in inner and data is not None and len(data) % 8 == 0 and len(data) >= 32
        if sealed or is_key(data, 1):
            out.append(("pem", m.start(), end + len(foot)))
        at = end + len(foot)
    return out


def is_signed_token(parts: list[str]) -> bool:
    """header.payload.signature with a JSON header that names an algorithm and a JSON payload."""
    if len(parts[2]) < 16:
        return False
    try:
        header = json.loads(decode_base64(parts[0]) or b"")
        payload = json.loads(decode_base64(parts[1]) or b"")
    except (ValueError, RecursionError):
        return False
    return (isinstance(header, dict) and isinstance(header.get("alg"), str) and header["alg"].lower() != "none"
            and isinstance(payload, dict) and decode_base64(parts[2]) is not None)


def confirmed_spans(text: str) -> list[Span]:
    """Spans of encoded candidates that parse. Each maximal run is cut at its dots
    and inner equals signs and each piece decoded once, so the work is linear in the text."""
    out: list[Span] = []
    for m in _RUN.finditer(text):
        run, start = m[0], m.start()
        atoms = [(x.start(), x.end()) for x in _ATOM.finditer(run)]
        i = 0
        while i < len(atoms):
            a, b = atoms[i]
            dotted = atoms[i:i + 3] if all(
                j + 1 < len(atoms) and atoms[j + 1][0] == atoms[j][1] + 1 and run[atoms[j][1]] == "."
                for j in (i, i + 1)) else ()
            if dotted and is_signed_token([run[x:y] for x, y in dotted]):
                out.append(("jwt", start + a, start + dotted[2][1]))
                i += 3
                continue
            if b - a >= 43 and is_key(decode_base64(run[a:b])):
                out.append(("key", start + a, start + b))
            i += 1
        for h in _HEX_ANY.finditer(run):
            if len(h[0]) % 2 == 0 and h[0][:2] in ("30", "6f", "6F", "2d", "2D") and is_key(bytes.fromhex(h[0])):
                out.append(("hexkey", start + h.start(), start + h.end()))
    pems = pem_spans(text) if "PRIVATE KEY-----" in text else []
    starts = [a for _, a, _ in pems]
    for m in _WRAPPED.finditer(text):
        nth = bisect_right(starts, m.start()) - 1
        inside = nth >= 0 and m.end() <= pems[nth][2]
        if not inside and is_key(decode_base64(_BREAK.sub("", m[0]))):
            out.append(("key", m.start(), m.end()))
    return out + pems


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], RANK[s[0]])))


def scan_text(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, confirmed spans) in code points, end exclusive; a null text counts as empty."""
    text = text or ""
    return base_spans(text), confirmed_spans(text)


def redact(text: str | None, spans: Iterable[Span], mask: str = "[SECRET]") -> str | None:
    """``text`` with the union of the spans replaced by ``mask``."""
    if text is None:
        return None
    out, at = [], 0
    for a, b in merged(spans):
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def merged(spans: Iterable[Span]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if out and a < out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed) of every row.

    Map-only: each row is judged where it is read, whatever its source or copies. Null
    and empty texts have no spans; null ids and repeated rows stay. Other columns are left out.
    """
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, more = scan_text(text.as_py())
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(joined(base).encode()).hexdigest(),
                             joined(base + more), len(more)))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])

    out = slim.mapInArrow(run, f"id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, "
                               "spans string, n_confirmed long")
    return out.withColumnRenamed("id", id_col)


def redact_rows(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Every row of ``docs`` with all found secrets masked in ``text_col``; other columns unchanged.

    A null text stays null. Map-only."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value in batch.column(at):
                text = value.as_py()
                base, more = scan_text(text)
                texts.append(redact(text, base + more, mask) if base or more else text)
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
