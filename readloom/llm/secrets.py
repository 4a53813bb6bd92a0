"""Secrets in texts, and in what texts hide: a worklist of decoded layers, each scanned anew.

Base spans, of the text as it is, leftmost and not overlapping within a kind:
``assign``  a password, secret, token or api key that is given a value of 6 characters or more,
``access``  AKIA and capitals or digits, 20 characters or more,
``hex``     24 or more of 0-9a-f.

A text then goes to a worklist. An item is unwrapped in every way that applies: percent-encoding and
Unicode escapes line by line, base64 (also URL-safe) runs that decode to text, and gzip, zlib, bzip2 or
xz streams inside decoded bytes. Each new layer is scanned and goes to the list itself, until nothing unwraps any
more. A layer that equals one it was made from is a cycle and isn't followed. A hit in a layer is mapped
through all layers to the characters of the text that it came from: character by character where an
escape stands for one, to the base64 characters that hold its bytes, to a whole run for a compressed stream. Added spans
never take base spans away; a span is listed once.

Null and blank texts have no spans. Texts of any length are scanned whole; only lines with something to
unwrap are copied. A stream may grow to ``MOST`` bytes; what comes after isn't seen, and ``n_cut`` counts
such streams of a document (guard against decompression bombs; 0 means that everything was seen). Rows are
independent: repeated rows, shared or null ids change nothing. An empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession

from . import tables

KINDS = ("assign", "access", "hex")
#: Bytes that one compressed stream may give.
MOST = 8 << 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("passw", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_MAGIC = re.compile("\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]")
_CONTROL = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f]")


def scan(text: str):
    """(start, kind's number, end) of the secrets that stand in a text as it is, in order."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


class Layer:
    """Text made from a part of another layer. ``spans`` maps characters back: ascending (place in the text,
    start and end in the parent) of pieces; within a piece of equal length places run along, others
    stand for their whole piece."""

    __slots__ = ("text", "parent", "at", "spans", "bits")

    def __init__(self, text, parent=None, spans=None, bits=False):
        self.text, self.parent, self.spans, self.bits = text, parent, spans, bits
        self.at = [s[0] for s in spans] if spans else []

    def _one(self, i: int, end: bool) -> int:
        k = bisect_right(self.at, i) - 1
        place, a, b = self.spans[k]
        n = (self.at[k + 1] if k + 1 < len(self.at) else len(self.text)) - place
        if n == b - a:
            return a + (i - place) + end
        return b if end else a

    def home(self, a: int, b: int) -> tuple[int, int]:
        """The span of the outermost text that characters a to b come from."""
        layer = self
        while layer.parent is not None:
            a, b = layer._one(a, False), layer._one(b - 1, True)
            layer = layer.parent
        return a, b


def _replaced(layer: Layer, pattern, decode):
    """A layer for each line in which ``pattern`` occurs, its matches replaced. decode: a match's text to (characters,
    their number of source characters) pieces, or None to leave it."""
    text, done = layer.text, -1
    for m in pattern.finditer(text):
        if m.start() < done:
            continue
        a = text.rfind("\n", 0, m.start()) + 1
        b = text.find("\n", m.start())
        b = done = len(text) if b < 0 else b
        out, spans, n, last = [], [], 0, a
        for x in pattern.finditer(text, a, b):
            got = decode(x[0])
            if got is None:
                continue
            if x.start() > last:
                spans.append((n, last, x.start()))
                out.append(text[last : x.start()])
                n += x.start() - last
            at = x.start()
            for chars, width in got:
                spans.append((n, at, at + width))
                out.append(chars)
                n, at = n + len(chars), at + width
            last = x.end()
        if out:
            if last < b:
                spans.append((n, last, b))
                out.append(text[last:b])
            yield Layer("".join(out), layer, spans)


def _characters(raw: bytes, width: int):
    """(character, source characters) of bytes that are ``width`` source characters each: UTF-8 where valid, else
    a character a byte."""
    try:
        return [(c, width * len(c.encode())) for c in raw.decode("utf-8")]
    except UnicodeDecodeError:
        return [(chr(x), width) for x in raw]


def percent(layer: Layer, _cut):
    return _replaced(layer, _PERCENT, lambda x: _characters(bytes.fromhex(x.replace("%", "")), 3))


def _escaped(x: str):
    if x.startswith("&#"):
        n = int(x[3:-1], 16) if x[2] in "xX" else int(x[2:-1])
    elif x[1] == "u" and x[2] != "{":
        units = [x[i + 2 : i + 6] for i in range(0, len(x), 6)]
        chars = bytes.fromhex("".join(units)).decode("utf-16-be", "replace")
        return [(c, 6 * (1 + (ord(c) > 0xFFFF))) for c in chars]
    else:
        n = int(x.strip("\\uUx{}"), 16) if x[2] == "{" else int(x[2:], 16)
    return [(chr(n), len(x))] if n < 0x110000 and not 0xD800 <= n < 0xE000 else None


def escapes(layer: Layer, _cut):
    return _replaced(layer, _ESCAPE, _escaped)


def _inflate(raw, cut: list):
    """(content, bytes taken) of a compressed stream at the start of raw, at most MOST bytes of content, or None."""
    head = bytes(raw[:6])
    try:
        if head[:2] == b"\x1f\x8b":
            d = zlib.decompressobj(31)
        elif head[:3] == b"BZh":
            d = bz2.BZ2Decompressor()
        elif head == b"\xfd7zXZ\x00":
            d = lzma.LZMADecompressor()
        elif head[:1] == b"\x78" and len(head) > 2 and (head[0] * 256 + head[1]) % 31 == 0:
            d = zlib.decompressobj()
        else:
            return None
        out = d.decompress(raw, MOST + 1)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
        return None
    if len(out) > MOST:
        cut.append(1)
        out = out[:MOST]
    return (out, len(raw) - len(d.unused_data)) if out else None


def _content(raw: bytes) -> str:
    """A stream's content as text; bytes that hold another stream stay a character each."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _text(raw: bytes, cut: list):
    """(text, whether its places are those of raw's bytes): text of bytes that hold one, compressed or not, or None."""
    inner = _inflate(raw, cut)
    if inner is not None:
        return _content(inner[0]), False
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if _CONTROL.search(text) else (text, True)


def _decoded(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def base64_runs(layer: Layer, cut: list):
    """A layer for each run that decodes to text; a run that doesn't is tried in its parts between '/', '-' and '_'."""
    for m in _BASE64.finditer(layer.text):
        runs = [(m.start(), m[0])]
        while runs:
            at, run = runs.pop()
            raw = _decoded(run)
            got = _text(raw, cut) if raw else None
            if got is None:
                if at == m.start() and run == m[0]:
                    runs = [(m.start() + x.start(), x[0]) for x in re.finditer(r"[A-Za-z0-9+]{16,}={0,2}", run) if x[0] != run]
                continue
            text, plain = got
            if plain:
                spans, n, k = [], 0, 0
                for c in text:
                    size = len(c.encode())
                    spans.append((n, at + k * 4 // 3, at + -(-(k + size) * 4 // 3)))
                    n, k = n + 1, k + size
            else:
                spans = [(0, at, at + len(run))]
            yield Layer(text, layer, spans)


def streams(layer: Layer, cut: list):
    """A layer for each compressed stream that stands in a layer's characters, a byte each."""
    if layer.parent is None and not _CONTROL.search(layer.text):
        return
    raw, done = memoryview(layer.text.encode("latin-1", "replace")), -1
    for m in _MAGIC.finditer(layer.text):
        inner = _inflate(raw[m.start() :], cut) if m.start() >= done else None
        if inner is not None:
            done = m.start() + inner[1]
            yield Layer(_content(inner[0]), layer, [(0, m.start(), done)])


DECODERS = (percent, escapes, base64_runs, streams)


def found(text: str, decoders=DECODERS) -> tuple[list, set, int]:
    """(base spans, all spans, streams cut) of a text; spans are (start, kind's number, end)."""
    base = scan(text)
    spans, cut = set(base), []
    work = [(Layer(text), frozenset())]
    while work:
        layer, above = work.pop()
        for decode in decoders:
            for new in decode(layer, cut):
                digest = hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).digest()
                if digest in above or new.text == text:
                    continue
                for a, kind, b in scan(new.text):
                    start, end = new.home(a, b)
                    spans.add((start, kind, end))
                work.append((new, above | {digest}))
    return base, spans, len(cut)


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_cut long"


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA of each row of docs; the id keeps its own name and type."""
    kind = docs.schema[doc_id].dataType.simpleString()
    names = SCHEMA.split(", ", 1)[1]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for t in batch["_text"].to_pylist():
                base, spans, cut = found(t or "")
                n = [sum(x[1] == k for x in base) for k in range(3)]
                rows.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), cut))
            cols = list(zip(*rows)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["_id"], *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cut"])

    rows = docs.select(docs[doc_id].alias("_id"), docs[text].cast("string").alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, {names}").withColumnRenamed("_id", doc_id)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(tables.table(spark, sf_dir, "documents"))
