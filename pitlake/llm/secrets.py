"""Secrets in whole texts: plain patterns, and candidates confirmed by their structure.

Plain kinds (assign, access, hex) are pattern matches.  The other kinds are
reported only when a candidate, once decoded from base64 or hex, has the inner
structure of what it claims to be:

* jwt: three base64url parts, of which the first is a JSON object that names an
  algorithm and the second a JSON object;
* pem: a private-key block whose body is DER with lengths that nest exactly, or
  the length-prefixed fields of the public OpenSSH container; line ends may be
  escaped, as in JSON;
* der: bare base64 that is such a DER private key, in one run or wrapped;
* hexder: the same in hex.

Every place where a token or a key may begin is tried, also inside a longer run; a
key ends where its own length says, whatever follows it.  A run is decoded once for
each place in a group where it may begin.  A header nests ``DEPTH`` levels at most
and a key has ``ITEMS`` items at most, so that what a start costs is bounded.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import importable, texts_of

#: Levels of a token's header; items of a key with all that is nested in it (an RSA key has about a dozen).
DEPTH, ITEMS = 16, 256
#: The plain patterns and the least length of what counts.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "hexder")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need not be met
# a whole run as the header's, and what follows it, which may be the header of a further token
_JWT = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}+(?=\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+))")
_JWT_HEAD = re.compile(r"e[wy]")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\+[nrt/])+)-----END \1-----")
_WRAP = re.compile(r"(?:\s|\\+[nrt])++")
_PAD = re.compile(r"={0,2}")
#: Runs of 16 or more in which a key may begin, runs that may continue it, and how a key begins: a SEQUENCE whose first item is a version of 0 to 3.
_RUN = {"der": re.compile(r"[A-Za-z0-9+/]++"), "hexder": re.compile(r"[0-9A-Fa-f]++")}
_LONG_RUN = {"der": re.compile(r"[A-Za-z0-9+/]{16,}+"), "hexder": re.compile(r"[0-9A-Fa-f]{16,}+")}
_HEAD = {
    "der": re.compile(r"M(?=[A-I][A-Za-z0-9+/]{10})"),
    "hexder": re.compile(r"(?=30(?:[0-7][0-9A-Fa-f]|81..|82.{4}|83.{6}|84.{8})02010[0-3])"),
}
_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|[{\[]|[}\]]|[ \t\r\n:,0-9A-Za-z+.-]++', re.S)
_BLANK = re.compile(r"[ \t\r\n]*")
_OPENSSH = b"openssh-key-v1\0"


def _unbase64(text: str, url: bool = False) -> bytes | None:
    text = "".join(text.split())
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _unbase64(part, url=True)
    try:
        got = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def der_items(raw: bytes, at: int, end: int, depth: int = 0, left: list[int] | None = None) -> list[int] | None:
    """Tags of the items that fill raw[at:end] exactly, nested ones checked too; None if they don't, or are over ``ITEMS``."""
    tags, left = [], [ITEMS] if left is None else left
    while at < end:
        left[0] -= 1
        if at + 2 > end or depth > 12 or left[0] < 0:
            return None
        tag, size = raw[at], raw[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            size = int.from_bytes(raw[at : at + width], "big")
            at += width
        if at + size > end or tag & 0x1F == 0x1F:
            return None
        if tag & 0x20 and der_items(raw, at, at + size, depth + 1, left) is None:
            return None
        tags.append(tag)
        at += size
    return tags


def is_der_key(raw: bytes | None, at: int = 0, end: int | None = None) -> bool:
    """A SEQUENCE that fills raw[at:end], opens with a version INTEGER and goes on with a key's fields."""
    end = len(raw or b"") if end is None else end
    if not raw or end - at < 2 or raw[at] != 0x30:
        return False
    head = at + 2 + (raw[at + 1] & 0x7F if raw[at + 1] & 0x80 else 0)
    if head - at > 6 or raw[at + 1] == 0x80 or end < head + 3 or end - head != (int.from_bytes(raw[at + 2 : head], "big") if raw[at + 1] & 0x80 else raw[at + 1]):
        return False
    inner = der_items(raw, head, end) or []
    return len(inner) >= 3 and inner[0] == 0x02 and raw[head + 1] == 1 and raw[head + 2] <= 3 and any(t in (0x02, 0x04) for t in inner[1:])


def _is_openssh(raw: bytes | None) -> bool:
    """Cipher, key derivation and its options as length-prefixed strings, a count, then key blobs."""
    if not raw or not raw.startswith(_OPENSSH):
        return False
    at, fields = len(_OPENSSH), 0
    while fields < 3:
        size = int.from_bytes(raw[at : at + 4], "big")
        at += 4 + size
        fields += 1
        if at + 4 > len(raw):
            return False
    keys = int.from_bytes(raw[at : at + 4], "big")
    at += 4
    for _ in range(min(keys, 8) + 1):
        size = int.from_bytes(raw[at : at + 4], "big")
        at += 4 + size
        if at > len(raw):
            return False
    return 1 <= keys <= 8 and at == len(raw)


def _closes(body: str, at: int) -> int:
    """Where the object that opens at ``at`` closes; 0 if it doesn't, or nests deeper than ``DEPTH``.

    A place is met from ``DEPTH`` starts around it at most, or twice as many where
    what is text for one is structure for another.
    """
    depth = 0
    while token := _TOKEN.match(body, at):
        at = token.end()
        first = token[0][0]
        if first in "{[":
            depth += 1
            if depth > DEPTH:
                return 0
        elif first in "}]":
            depth -= 1
            if not depth:
                return at
    return 0


def _jwts(text: str) -> Iterator[tuple[int, int]]:
    """Spans of tokens; of the starts in a run that give a header the first counts.

    A run is decoded once for each of the four places where base64 may begin; where a
    header would stand in that, it has to close where the run ends before it is read.
    """
    for m in _JWT.finditer(text):
        payload, decoded = None, {}
        for at in _JWT_HEAD.finditer(text, m.start(), m.end() - 6):
            begin = base64.b64decode(text[at.start() : at.start() + 4], altchars=b"-_")
            if begin[1:2] not in b'" \t\r\n':
                continue
            skip = at.start() - m.start()
            lead = skip % 4
            if lead not in decoded:
                decoded[lead] = (_unbase64(m[0][lead:], url=True) or b"").decode("latin-1")
            body = decoded[lead]
            first = (skip - lead) // 4 * 3
            end = _closes(body, first)
            if not end or _BLANK.match(body, end).end() != len(body):
                continue
            header = _json_object(text[at.start() : m.end()])
            if header is None or not isinstance(header.get("alg"), str):
                continue
            payload = payload or _json_object(m[1]) is not None
            if payload:
                yield at.start(), m.end(2)
            break


def _decoded(joined: str, lead: int, kind: str) -> bytes:
    """What stands from ``lead`` on, as far as it decodes."""
    if kind == "hexder":
        return bytes.fromhex(joined[lead : lead + (len(joined) - lead) // 2 * 2])
    # three characters at the end still hold two bytes, two one
    return base64.b64decode(joined[lead : len(joined) - ((len(joined) - lead) % 4 == 1)] + "==")


def _keys(text: str, kind: str) -> Iterator[tuple[int, int]]:
    """Spans of DER keys in base64 or hex, leftmost first, none inside another.

    Runs with nothing but line ends or blanks between them are joined; a key begins
    anywhere in that and takes as many characters as its length says.
    """
    step = 2 if kind == "hexder" else 4  # characters of a group, and the bytes they are
    unit = 1 if kind == "hexder" else 3
    stop = 0
    while begin := _LONG_RUN[kind].search(text, stop):
        run, firsts, begins, parts, total = _RUN[kind].match(text, begin.start()), [], [], [], 0
        while run:
            firsts.append(run.start())
            begins.append(total)
            parts.append(run[0])
            total += len(run[0])
            stop = run.end()
            gap = _WRAP.match(text, stop)
            run = gap and _RUN[kind].match(text, gap.end())
        joined, decoded, done = "".join(parts), {}, 0
        for m in _HEAD[kind].finditer(joined):
            first = m.start()
            if first < done:
                continue
            lead = first % step
            if lead not in decoded:
                decoded[lead] = _decoded(joined, lead, kind)
            raw, at = decoded[lead], (first - lead) // step * unit
            if raw[at] != 0x30 or len(raw) < at + 2 or raw[at + 1] == 0x80:
                continue
            width = raw[at + 1] & 0x7F if raw[at + 1] & 0x80 else 0
            size = 2 + width + (int.from_bytes(raw[at + 2 : at + 2 + width], "big") if width else raw[at + 1])
            if width > 4 or at + size > len(raw) or not is_der_key(raw, at, at + size):
                continue
            done = first + -(-size * step // unit)
            i, j = bisect.bisect_right(begins, first) - 1, bisect.bisect_left(begins, done) - 1
            end = firsts[j] + done - begins[j]
            yield firsts[i] + first - begins[i], _PAD.match(text, end).end() if kind == "der" and size % 3 else end


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed; an empty text has none."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    found += [("jwt", a, b) for a, b in _jwts(text)]
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            raw = _unbase64(_WRAP.sub("", m[2]).replace("\\", ""))
            if is_der_key(raw) or _is_openssh(raw) or m[1].startswith("ENCRYPTED") and raw and der_items(raw, 0, len(raw)) == [0x30]:
                found.append(("pem", m.start(), m.end()))
    found += [(kind, a, b) for kind in _HEAD for a, b in _keys(text, kind)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


_SPAN = "array<struct<kind: string, start: long, end: long>>"


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t.as_py() or "")] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end; code points, end exclusive).

    A null text is empty and has no span.  An empty table gives an empty result;
    repeated rows are scanned each; further columns are not looked at.  Rows without an id
    are left out.
    """
    return texts_of(docs, id_col, text_col).mapInArrow(_scanned, f"doc_id long, spans {_SPAN}")


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """``text`` with each maximal run of secret spans replaced by ``mark``."""
    out, at, last = [], 0, -1
    for _, start, end in find_secrets(text):
        if start > last:
            out += [text[at:start], mark]
        last = max(last, end)
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with the secrets of ``text_col`` replaced; all rows and columns stay.

    ``length_col``, if the table has it, becomes the new number of characters of
    changed texts.  Null texts stay null.
    """
    importable(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.columns))
            old = columns[text_col].to_pylist()
            new = [t if t is None else redact(t, mark) for t in old]
            columns[text_col] = pa.array(new, columns[text_col].type)
            if length_col in columns:
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, columns[length_col].to_pylist())]
                columns[length_col] = pa.array(sizes, columns[length_col].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(run, docs.schema)
