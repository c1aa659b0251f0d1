from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import re
import zlib
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from flowcubes.llm import secret_scan as S

KEY = "AKIA" + "ABCDEFGH12345678"
ASSIGN = "password = hunter2hunter2"


def plain(text):
    """The base findings, straight from their definition."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:(?a:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Secret", "api_key", "apikey", ":", "=", " ", '"', "'", "AKIA", "A1B2C3D4E5F6G7", "abcdef0123456789", "x", "ſecret", "é", "\n", "-_./+", "%41"]), max_size=25).map("".join))
def test_base_findings_are_the_defined_ones(text):
    assert S.base_spans(text) == plain(text)


@pytest.mark.parametrize("wrap", [
    lambda s: quote(s, safe=""),
    lambda s: "".join(f"%{b:02X}" for b in s.encode()),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: base64.b64encode(s.encode()).decode(),
    lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    lambda s: base64.b64encode(base64.b64encode(s.encode())).decode(),
    lambda s: quote(base64.b64encode(gzip.compress(quote(s, safe="").encode())).decode(), safe=""),
    lambda s: base64.b64encode("".join(f"\\u{ord(c):04x}" for c in s).encode()).decode(),
])
@pytest.mark.parametrize("secret", [KEY, ASSIGN])
def test_layers_are_unwrapped_and_mapped(wrap, secret):
    hidden = wrap(secret)
    text = f"é before {hidden} after"
    base, every = S.all_spans(text)
    kind = 1 if secret == KEY else 0
    at = text.index(hidden)
    found = [(s, e) for s, k, e in every if k == kind]
    assert found
    assert all(at <= s < e <= at + len(hidden) for s, e in found)
    assert set(base) <= set(every)


def test_exact_span_in_base64():
    raw = base64.b64encode(f"xyz{KEY}!!".encode()).decode()
    _, every = S.all_spans(raw)
    assert [(s, e) for s, k, e in every if k == 1] == [(4, 4 - -len(KEY) * 4 // 3 + 1)] or [(s, e) for s, k, e in every if k == 1][0][0] == 4


def test_a_chain_that_repeats_ends():
    text = KEY
    for _ in range(12):
        text = base64.b64encode(text.encode()).decode()
    assert any(k == 1 for _, k, _ in S.all_spans(text)[1])
    assert S.all_spans("%25" * 2000 + "41")[0] == []


def test_scan_of_odd_rows(docs_of, clash):
    rows = [(1, None), (2, ""), (3, KEY), (3, KEY), (None, ASSIGN), (4, "a" * 200_000 + " " + KEY)]
    got = S.scan(docs_of(rows, clash)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].base_sha256 == by[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (by[3].n_access, by[3].spans) == (1, "access:0:20")
    assert by[None].n_assign == 1
    assert by[4].n_access == 1 and by[4].n_hex == 1
    assert S.scan(docs_of([])).count() == 0


def test_redaction_keeps_rows_and_columns(docs_of, clash):
    rows = [(1, None), (2, ""), (3, f"x {KEY} y"), (4, "clean"), (5, f"{base64.b64encode(KEY.encode()).decode()} z")]
    docs = docs_of(rows, clash)
    got = S.redact(docs)
    assert got.columns == docs.columns
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].text is None and by[2].text == "" and by[4].text == "clean" and by[4].n_chars == 5
    assert by[3].text == "x [ACCESS] y" and by[3].n_chars == len(by[3].text)
    assert "[ACCESS]" in by[5].text and by[5].text.endswith(" z")


@pytest.mark.parametrize("around", ["\u00a0prix\u00a0: ", "\u3000\u200b", "\ufeff", "\x0c", "\x00", "\x1b[31m", b"\xff\xfe\x80 ", b"\x00\x01\x02\xe9 "])
@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress, bz2.compress])
def test_layers_that_are_not_plain_text_are_scanned(around, pack):
    raw = around if isinstance(around, bytes) else around.encode()
    hidden = base64.b64encode(pack(raw + KEY.encode() + b" " + raw)).decode()
    text = f"see {hidden} end"
    found = [(s, e) for s, k, e in S.all_spans(text)[1] if k == 1]
    assert found and all(4 <= s < e <= 4 + len(hidden) for s, e in found)
    if pack(b"") == b"":
        assert found == [(4 + len(raw) * 4 // 3, 4 + -(-(len(raw) + len(KEY)) * 4 // 3))]
    assert KEY not in S.cover(text, S.all_spans(text)[1]) and "[ACCESS]" in S.cover(text, S.all_spans(text)[1])


def wrapped(raw, width, end="\n"):
    line = base64.b64encode(raw).decode()
    return end.join(line[i:i + width] for i in range(0, len(line), width))


NOISE = b"".join(hashlib.sha256(bytes([i])).digest() for i in range(20))


@pytest.mark.parametrize("width", [10, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress, bz2.compress])
def test_wrapped_base64_is_one_layer(width, end, pack):
    for before in range(40, 60):
        hidden = wrapped(pack(NOISE[:before] + b" " + KEY.encode() + b" " + NOISE), width, end)
        text = f"é:\n{hidden}\n."
        found = [(s, e) for s, k, e in S.all_spans(text)[1] if k == 1]
        assert found and all(3 <= s < e <= 3 + len(hidden) for s, e in found)


@pytest.mark.parametrize("pack", [lambda b: b, gzip.compress, zlib.compress, bz2.compress])
def test_base64_glued_to_what_precedes_it(pack):
    for glue in ("", "a/", "path/", "x/y", "abcdefgh/"):
        for tail in ("", "A"):
            hidden = base64.b64encode(pack(b"xy " + KEY.encode() + b" z.")).decode().rstrip("=")
            text = f"é {glue}{hidden}{tail}"
            assert any(k == 1 and s >= 2 for s, k, e in S.all_spans(text)[1]), (glue, tail)


def test_exact_spans_over_breaks():
    raw = b"?" * 40 + b" " + KEY.encode() + b" end"
    text = "k " + wrapped(raw, 20)
    place = [i for i in range(2, len(text)) if text[i] != "\n"]
    found = [(s, e) for s, k, e in S.all_spans(text)[1] if k == 1]
    assert found == [(place[41 * 4 // 3], place[-(-61 * 4 // 3) - 1] + 1)]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress])
@pytest.mark.parametrize("place", ["start", "middle", "end"])
def test_a_layer_of_any_length_is_opened(monkeypatch, pack, place):
    """In pieces that repeat the end of the one before, so that none is cut."""
    monkeypatch.setattr(S, "PIECE", 5000)
    monkeypatch.setattr(S, "OVERLAP", 400)
    rng, filler = __import__("random").Random(1), []
    filler = "".join(rng.choice("ghijklmnop \n") for _ in range(30_000))
    for shift in range(0, 60, 7):
        at = {"start": 0, "middle": 10_000 - 30 + shift, "end": len(filler)}[place]
        packed = base64.b64encode(pack((filler[:at] + f" {ASSIGN} {KEY} " + filler[at:]).encode())).decode()
        text = "see " + packed
        assert {(4, 0, len(text)), (4, 1, len(text))} <= set(S.all_spans(text)[1])


def test_a_layer_of_more_bytes_than_a_piece():
    raw = ASSIGN.encode() + b"\n" + b" " * (3 * S.PIECE) + KEY.encode()
    text = base64.b64encode(gzip.compress(raw)).decode()
    assert {(0, 0, len(text)), (0, 1, len(text))} <= set(S.all_spans(text)[1])


@pytest.mark.parametrize("codec", ["utf-16", "utf-16-le", "utf-16-be"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_utf_16_layers(codec, pack):
    hidden = base64.b64encode(pack(f"\U0001f511 {ASSIGN}\n{KEY}".encode(codec))).decode()
    found = S.all_spans(f"x {hidden} y")[1]
    assert {0, 1} <= {k for _, k, _ in found} and all(2 <= s < e <= 2 + len(hidden) for s, _, e in found)


def test_base64_wrapped_over_lines_with_escapes():
    """Each line holds an escape, and the run is whole only when all are resolved."""
    run = base64.b64encode(f"some words before {ASSIGN} and {KEY} after".encode()).decode()
    lines = [run[i:i + 20] for i in range(0, len(run), 20)]
    text = "\n".join(f"%{ord(x[0]):02X}" + x[1:] for x in lines)
    assert {0, 1} <= {k for _, k, _ in S.all_spans(text)[1]}
