"""Secret scans with a recursive decoding worklist.

A text is scanned for three kinds of secrets. Then every percent-encoded, Unicode-escaped,
base64 or compressed run in it is decoded to a layer of its own, which is scanned and unwrapped
in the same way, until no layer yields a new one. A digest of every layer of a document is
kept, so that a layer that leads back to itself is not walked again. Bytes that are no UTF-8 are read as one
character each, so a layer is scanned whatever it holds. Every finding of an inner layer is mapped
through all layers to the characters of the whole text that it was decoded from; in a compressed
layer these are the whole compressed run.

Defined cases: null and empty texts have no findings; overlapping findings of different kinds
stay; repeated rows are scanned each; other columns are ignored. Whole texts are read. A
compressed layer is inflated in full up to ``MAX_LAYER`` bytes; one beyond that (a compression
bomb) is scanned in consecutive windows that overlap, so that memory stays bounded.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cached_property
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import digest, joined_spans
from tidemark.llm.textkit import slices

KINDS = ("assign", "access", "hex")
#: Bytes of one window of an inflated layer, and how much of it the next window repeats.
MAX_LAYER = 8 << 20
OVERLAP = 64 << 10
REDACTED = "[secret]"

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_SOLID = re.compile(r"[!-~]+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_NEXT_LINE = re.compile(r"\r?\n([A-Za-z0-9+/_-]+={0,2})")
_BREAKS = re.compile(r"[\r\n]+")
_PERCENT_TOKEN = re.compile(r"%[0-9A-Fa-f]{2}|.")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
_ESCAPE_TOKEN = re.compile(rf"{_ESCAPE.pattern}|.")
_PAIR = re.compile("[\ud800-\udbff][\udc00-\udfff]")
_PAIR_TOKEN = re.compile(f"{_PAIR.pattern}|(?s:.)")
_LONE = re.compile("[\ud800-\udfff]")
_GZIP = b"\x1f\x8b"

SCHEMA = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
    "n_layers int, redacted string"
)


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets written openly in a text, by start, then kind."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


class Layer:
    """A decoded text, with the characters of its parent that each of its characters came from.

    ``cuts`` gives their (starts, ends); a layer without (an inflated one) came from its
    ``place`` in the parent as a whole. They are worked out only for layers with findings.
    """

    def __init__(self, text: str, parent: Layer | None = None, place: tuple[int, int] = (0, 0), cuts=None):
        self.text, self._parent, self._place, self._make = text, parent, place, cuts

    @cached_property
    def _cuts(self) -> tuple[np.ndarray, np.ndarray]:
        return self._make()

    def locate(self, start: int, end: int) -> tuple[int, int]:
        """The characters of the whole text that characters ``start`` to ``end`` came from."""
        if self._parent is None:
            return start, end
        if self._make is None:
            return self.outer
        starts, ends = self._cuts
        return self._parent.locate(int(starts[start]), int(ends[end - 1]))

    @cached_property
    def outer(self) -> tuple[int, int]:
        """The characters of the whole text that the layer came from."""
        return self._place if self._parent is None else self._parent.locate(*self._place)


def _inflated(data: bytes) -> Iterator[str]:
    """Texts of gzip or zlib streams, in overlapping windows of bounded size."""
    if data[:2] != _GZIP and not (data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0):
        return
    machine, held = zlib.decompressobj(47), b""
    try:
        while data:
            piece = machine.decompress(data, MAX_LAYER)
            data = machine.unconsumed_tail
            if machine.eof and machine.unused_data[:2] == _GZIP:  # another member follows
                data, machine = machine.unused_data, zlib.decompressobj(47)
            elif not piece:
                break
            held += piece
            yield _text(held)[0]
            held = held[-OVERLAP:]
    except zlib.error:
        return


def _text(data: bytes) -> tuple[str, bool]:
    """(the bytes as UTF-8, or one character each where they are none; are they UTF-8?)."""
    try:
        return data.decode("utf-8"), True
    except UnicodeDecodeError:
        return data.decode("latin-1"), False


def _from_bytes(data: bytes, parent: Layer, place: tuple[int, int], cuts) -> Iterator[Layer]:
    """Layers of decoded bytes; ``cuts`` gives the parent's characters of each byte."""
    inflated = False
    for piece in _inflated(data):
        inflated = True
        yield Layer(piece, parent, place)
    if inflated:
        return
    text, is_utf8 = _text(data)

    def by_character():
        starts, ends = cuts()
        if not is_utf8:
            return starts, ends
        first = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        return starts[first], ends[np.append(first[1:], len(data)) - 1]

    yield Layer(text, parent, place, by_character)


def _cut_at(tokens: re.Pattern, run: str, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of a run that starts at ``start``."""
    spans = np.array([m.span() for m in tokens.finditer(run)], np.int64).reshape(-1, 2) + start
    return spans[:, 0], spans[:, 1]


def _unescaped(run: str, parent: Layer, start: int) -> Layer:
    units = _ESCAPE.sub(lambda e: chr(int(e.group(1) or e.group(2), 16)), run)
    whole = _PAIR.sub(lambda p: chr(0x10000 + ((ord(p.group()[0]) & 0x3FF) << 10) + (ord(p.group()[1]) & 0x3FF)), units)

    def cuts():
        starts, ends = _cut_at(_ESCAPE_TOKEN, run, start)
        spans = np.array([m.span() for m in _PAIR_TOKEN.finditer(units)], np.int64).reshape(-1, 2)
        return starts[spans[:, 0]], ends[spans[:, 1] - 1]

    return Layer(_LONE.sub("\ufffd", whole), parent, (start, start + len(run)), cuts)


def _base64_runs(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of base64 runs, and of runs that are broken over lines of equal length."""
    done = 0
    for m in _BASE64.finditer(text):
        start, end = m.span()
        yield start, end
        width = end - start
        if start < done or width % 4 or text[end - 1] == "=":
            continue
        more = _NEXT_LINE.match(text, end)
        while more and len(more.group(1)) <= width:
            done = more.end()
            if len(more.group(1)) < width or text[done - 1] == "=":
                break
            more = _NEXT_LINE.match(text, done)
        if done > end:
            yield start, done


def _decoded(layer: Layer, start: int, end: int) -> Iterator[Layer]:
    raw = layer.text[start:end]
    run = _BREAKS.sub("", raw).rstrip("=")
    run = run[: len(run) - (len(run) % 4 == 1)].replace("-", "+").replace("_", "/")
    try:
        data = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return

    def cuts():
        kept = np.flatnonzero(~np.isin(np.array(list(raw)), ["\r", "\n"])) + start
        byte = np.arange(len(data)) * 8
        return kept[byte // 6], kept[(byte + 7) // 6] + 1

    yield from _from_bytes(data, layer, (start, end), cuts)


def _unwrapped(layer: Layer) -> Iterator[Layer]:
    """The layers that the encoded runs of a layer hold."""
    text = layer.text
    if "%" in text or "\\" in text:
        for m in _SOLID.finditer(text):
            run, start = m.group(), m.start()
            if "%" in run:
                data = unquote_to_bytes(run)
                if len(data) < len(run):
                    yield from _from_bytes(data, layer, m.span(), lambda r=run, s=start: _cut_at(_PERCENT_TOKEN, r, s))
            if "\\" in run and _ESCAPE.search(run):
                yield _unescaped(run, layer, start)
    for start, end in _base64_runs(text):
        yield from _decoded(layer, start, end)


def scan_layers(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], int]:
    """(open findings, all findings, number of inner layers); inner findings carry the
    characters of the whole text that they were decoded from."""
    base = scan(text)
    top = Layer(text)
    found, own, seen, layers = set(base), _mark(text), set(), 0
    work = [top]
    while work:
        layer = work.pop()
        for inner in _unwrapped(layer):
            mark = _mark(inner.text)
            if mark == own or (mark, inner.outer) in seen:
                continue
            seen.add((mark, inner.outer))
            layers += 1
            found.update((kind, *inner.locate(start, end)) for kind, start, end in scan(inner.text))
            work.append(inner)
    return base, sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2])), layers


def _mark(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every run of overlapping findings replaced by one mark."""
    out, done = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start >= done:
            out += [text[done:start], REDACTED]
        done = max(done, end)
    return "".join(out) + text[done:]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                base, spans, layers = scan_layers(text or "")
                kinds = [kind for kind, _, _ in base]
                rows.append(
                    {"doc_id": doc, **{f"n_{k}": kinds.count(k) for k in KINDS}, "base_sha256": digest(base),
                     "spans": joined_spans(spans), "n_layers": layers,
                     "redacted": None if text is None else redact(text, spans)}
                )
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


_ARROW = pa.schema(
    [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
     ("spans", pa.string()), ("n_layers", pa.int32()), ("redacted", pa.string())]
)


def find(documents: DataFrame) -> DataFrame:
    """Findings of every document, and its text without them."""
    return documents.select("doc_id", "text").mapInArrow(_rows, SCHEMA)


def cleaned(documents: DataFrame) -> DataFrame:
    """The documents with every secret in ``text`` replaced; all columns stay as they are.
    ``n_chars``, where there is one, is counted anew."""
    spark_type = documents.schema["text"].dataType
    place = documents.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [None if t is None else redact(t, scan_layers(t)[1]) for t in part.column(place).to_pylist()]
                columns = list(part.columns)
                columns[place] = pa.array(texts, part.schema.field(place).type)
                if "n_chars" in part.schema.names:
                    at = part.schema.get_field_index("n_chars")
                    sizes = [old if t is None else len(t) for old, t in zip(columns[at].to_pylist(), texts)]
                    columns[at] = pa.array(sizes, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    assert spark_type.simpleString() == "string"
    return documents.mapInArrow(run, documents.schema)
