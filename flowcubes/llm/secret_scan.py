"""Secret scan with a recursive decoding worklist.

Every text is scanned for three kinds of secrets. Then its URL-escaped,
Unicode-escaped, base64 and compressed parts are unwrapped into new layers,
which are scanned and unwrapped in turn until no new layer appears. Base64 is
read over line breaks and from each of the four places where it may begin in a
run; compressed bytes are looked for anywhere in what it decodes to. A layer
already seen at the same place is not taken again, so cycles end. Each
character of a layer knows the code points of the original text that it came
from, so every finding is a span of the original. Layers are taken depth first,
one at a time. What a compressed layer unpacks to, however long, is read in
pieces of at most PIECE bytes, each beginning with the last OVERLAP bytes of the
one before; only what is nested in it as a run of more than OVERLAP bytes over
such an edge is read in two parts.

Defined results: a null text scans as an empty one; repeated rows give equal
rows; a null id is passed through; an empty table gives an empty result; extra
columns are not read by `scan` and are kept by `redact`.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from flowcubes.llm.common import map_batches, map_whole

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run, as [0-9a-f]+ kept when of 16 or more
MIN_VALUE, MIN_ACCESS = 12, 18

ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}")
ESCAPE_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}")
#: A run, also over line breaks, of which LEAST_BASE64 characters are of the alphabet.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]+(?:[ \t]*(?:\r\n?|\n)[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
LEAST_BASE64 = 16
BREAK = re.compile(r"[ \t\r\n]+")
PACKED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]")
#: Unpacked bytes that are held at once, and how many of them the next piece repeats.
PIECE, OVERLAP = 8 << 20, 1 << 20

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """The plain findings: leftmost non-overlapping matches of each kind."""
    found = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _unescape(text: str) -> tuple[str, array, array] | None:
    """A text with its URL and Unicode escapes resolved, and for each new
    character the start and end of what it stands for."""
    out, starts, ends, at = [], array("q"), array("q"), 0
    for m in ESCAPE_RUN.finditer(text):
        run, lo = m.group(), m.start()
        if run[0] == "%":
            raw = bytes.fromhex(run.replace("%", ""))
            try:
                piece = raw.decode("utf-8")
                sizes = [3 * len(c.encode("utf-8")) for c in piece]
            except UnicodeDecodeError:
                piece, sizes = raw.decode("latin-1"), [3] * len(raw)
        elif run.startswith("\\u"):
            units = [run[i + 2:i + 6] for i in range(0, len(run), 6)]
            piece = bytes.fromhex("".join(units)).decode("utf-16-be", "replace")
            sizes = [6 * (1 + (ord(c) > 0xFFFF)) for c in piece]
            if sum(sizes) != len(run):
                continue
        else:
            code = int(run[2:], 16)
            if code > 0x10FFFF or 0xD800 <= code < 0xE000:
                continue
            piece, sizes = chr(code), [len(run)]
        out.append(text[at:lo])
        starts.extend(range(at, lo))
        ends.extend(range(at + 1, lo + 1))
        out.append(piece)
        for n in sizes:
            starts.append(lo)
            ends.append(lo + n)
            lo += n
        at = m.end()
    if not out:
        return None
    out.append(text[at:])
    starts.extend(range(at, len(text)))
    ends.extend(range(at + 1, len(text) + 1))
    return "".join(out), starts, ends


def _opened(raw: bytes | memoryview) -> Iterator[bytes]:
    """The content of gzip, zlib or bzip2 bytes in pieces, as far as it can be
    read; nothing if they are none of these."""
    carry = b""
    try:
        if raw[:2] == b"\x1f\x8b":
            packed = zlib.decompressobj(31)
        elif raw[:1] == b"\x78":
            packed = zlib.decompressobj()
        else:
            packed = bz2.BZ2Decompressor()
        while not packed.eof and (out := packed.decompress(raw, PIECE)):
            yield carry + out
            carry, raw = out[-OVERLAP:], getattr(packed, "unconsumed_tail", b"")
    except (zlib.error, OSError, ValueError, EOFError):
        return


def _inside(part: bytes) -> Iterator[bytes]:
    for m in PACKED.finditer(part):
        yield from _opened(memoryview(part)[m.start():])


def _unpacked(raw: bytes) -> Iterator[bytes]:
    """What the gzip, zlib and bzip2 bytes anywhere in ``raw`` unpack to, and
    those in what they unpack to, until nothing new appears."""
    work, seen = [_inside(raw)], set()
    while work:
        piece = next(work[-1], None)
        if piece is None:
            work.pop()
        elif (key := hashlib.blake2b(piece, digest_size=16).digest()) not in seen:
            seen.add(key)
            work.append(_inside(piece))
            yield piece


def _base64_runs(text: str):
    """(start, run without padding, end) of the runs that are long enough."""
    for m in BASE64.finditer(text):
        lo, hi = m.span()
        if hi - lo >= LEAST_BASE64:
            run = m.group().rstrip("=")
            if sum(map(len, BREAK.split(run))) >= LEAST_BASE64:
                yield lo, run, hi


def _texts(raw: bytes) -> Iterator[tuple[str, list[int]]]:
    """The decoded layers in which something is to be found, and the bytes of
    each of their characters: UTF-8, or else Latin-1, and where there are zero
    bytes UTF-16 of both orders."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
    if _worth(text):
        yield text, [1] * len(text) if len(text) == len(raw) else [len(c.encode("utf-8")) for c in text]
    if b"\0" in raw:
        for codec in ("utf-16-le", "utf-16-be"):
            text = raw[:len(raw) // 2 * 2].decode(codec, "surrogatepass")
            if _worth(text):
                yield text, [2 + 2 * (c > "\uffff") for c in text]


def _worth(text: str) -> bool:
    return bool(base_spans(text) or ESCAPE.search(text) or next(_base64_runs(text), None))


def _layers(text: str):
    """(new text, start and end in ``text`` of each new character, or one start
    and one end for all of them)."""
    if ESCAPE.search(text) and (new := _unescape(text)):
        yield new
    for lo, run, hi in _base64_runs(text):
        if BREAK.search(run):
            places = [lo + i for i, c in enumerate(run) if c not in " \t\r\n"]
            run = BREAK.sub("", run)
        else:
            places = range(lo, lo + len(run))
        run = run.translate(_URLSAFE)
        for skip in range(4):  # what precedes it may be glued to the encoded part
            body = run[skip:len(run) - ((len(run) - skip) % 4 == 1)]
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
            for opened in _unpacked(raw):
                for new, _ in _texts(opened):
                    yield new, lo, hi
            for new, sizes in _texts(raw):
                starts, ends, b = array("q"), array("q"), 0
                for n in sizes:
                    starts.append(places[skip + b * 4 // 3])
                    b += n
                    ends.append(places[skip - (-b * 4 // 3) - 1] + 1)
                yield new, starts, ends


_URLSAFE = str.maketrans("-_", "+/")


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, base spans and those of every decoded layer), both sorted."""
    base = base_spans(text)
    found, seen = set(base), set()
    work = [(_layers(text), None, None)]  # the layers of a layer, and its places in the text
    while work:
        layers, starts, ends = work[-1]
        layer = next(layers, None)
        if layer is None:
            work.pop()
            continue
        new, lo, hi = layer
        if isinstance(starts, int):
            lo, hi = starts, ends
        elif starts is not None:
            lo, hi = (starts[lo], ends[hi - 1]) if isinstance(lo, int) else (
                array("q", [starts[i] for i in lo]), array("q", [ends[i - 1] for i in hi]))
        one = isinstance(lo, int)
        at = f"{lo}:{hi}:" if one else f"{lo[0]}:{hi[-1]}:"
        key = hashlib.blake2b(at.encode() + new.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if key not in seen:
            seen.add(key)
            found.update((lo, k, hi) if one else (lo[s], k, hi[e - 1]) for s, k, e in base_spans(new))
            work.append((_layers(new), lo, hi))
    return base, sorted(found)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base findings, digest of their spans,
    and all spans. One narrow pass; nothing is shuffled."""

    def start():
        def step(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for text in batch.column("text").to_pylist():
                base, spans = all_spans(text or "")
                for i, k in enumerate(KINDS):
                    out[f"n_{k}"].append(sum(1 for s in base if s[1] == i))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return out | {"doc_id": batch.column("doc_id")}
        return step

    return map_batches(docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text"), start, SCHEMA)


def cover(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by its kind's mark."""
    out, at = [], 0
    for s, k, e in spans:
        if e <= at:
            continue
        if s >= at:
            out.append(text[at:s])
            out.append(f"[{KINDS[k].upper()}]")
        at = e
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets covered in ``text`` and ``n_chars``
    brought up to date where it is there and the text changed."""
    names = docs.columns
    at, length = names.index(text), names.index(n_chars) if n_chars in names else None

    def start():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column(at).to_pylist()
            new = [t if not t else cover(t, all_spans(t)[1]) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if length is not None:
                was = columns[length].to_pylist()
                columns[length] = pa.array([w if a == b else len(b) for w, a, b in zip(was, old, new)], columns[length].type)
            return pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        return step

    return map_whole(docs, start)
