"""Token counts from a compiled finite-state tokenizer.

The merges of a BPE vocabulary with word-end marks are compiled into a
deterministic transducer over bytes. What the encoding of a word's prefix does
next depends only on the longest suffix of it that begins a token, and on the
last token of the encoding at the places in that suffix where a token may
still begin; that is a state. A transition is annotated with by how many
tokens the encoding grows when the byte is read. States are compiled when they
are first reached and kept up to a bound.

White space always returns the machine to its start. So the map of a chunk of
text (from the state on entry to tokens and the state on exit) is written as
what is read before its first cut, the tokens of what is between, and what is
read after the last one. A cut is a place at which the machine is at its start
whatever came before: white space, an end of a word before other punctuation
than that of contractions and special strings, and either side of a digit.
Such maps compose associatively. Long texts are dealt out as chunks; a scan's
up-sweep composes the maps of ``FAN`` neighbours at a time, spread over all
tasks, until one map of each text is left. A map holds no more than two parts
without a cut, so a task holds ``FAN`` small maps, however long the text is; only
what has no cut at all for the length of chunks, such as one endless word, is
passed on whole.

Defined results: a null text counts as an empty one, with 0 tokens; a null id
is passed through; repeated rows give equal rows; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowcubes.llm.common import documents, map_batches, map_groups, split_long

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Code points of a chunk; longer texts are dealt out in several.
CHUNK = 16_384
#: Neighbouring maps that are composed at a time.
FAN = 64
MAX_STATES = 300_000
MAX_WORDS = 300_000
MAX_PAIRS = 1_000_000
FINAL = 0x10000  # added to a symbol that ends a word
BREAKS = " \t\n\r"
TO_SPACE = str.maketrans(BREAKS, " " * len(BREAKS))
#: Marks that never begin a contraction or stand before a letter in a special string.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~、。，．！？；：（）「」『』【】《》…"
#: Where a chunk may be cut: pre-tokens end there in any context, and no normal
#: form reaches over it.
CUT = rf"[{BREAKS}]|(?<=[0-9])(?=\P{{M}})|(?=[0-9])|(?<=[{re.escape(MARKS)}])(?=[A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff])"
FIRST_CUT, LAST_CUT = regex.compile(CUT), regex.compile(CUT, regex.REVERSE)


def byte_symbols() -> list[str]:
    """The printable symbol that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Transducer:
    """Counts the tokens of texts for a BPE file with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the library's white space is Unicode's, which Python's \s is not
        self.words_of = regex.compile(split.replace(r"\s", r"\p{White_Space}")).findall
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        symbols = [self.symbol(t) for t in model["vocab"]]
        self.tokens = set(symbols)
        self.prefixes = {t[:i] for t in symbols for i in range(1, len(t))}
        self.rank = {}
        for i, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[self.symbol(a), self.symbol(b)] = i
        self.bytes = byte_symbols()
        self.finals = [chr(ord(c) + FINAL) for c in self.bytes]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.reset()

    def symbol(self, token: str) -> str:
        """A token with its word end folded into its last symbol."""
        if token.endswith(self.suffix) and token != self.suffix:
            token = token[:-len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + FINAL)
        return token

    def reset(self) -> None:
        start = ("", (("", 0),))
        self.states, self.ids = [start], {start: 0}
        self.next: list[dict[str, tuple[int, int]]] = [{}]

    def merge(self, parts: list[str]) -> list[str]:
        """The encoding by definition: the earliest merge first, leftmost first."""
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 30))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        """Whether token b can stand right after token a (or first, after "")."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge([*a, *b]) == ([a, b] if a else [b])
        return known

    def compile(self, state: int, symbol: str) -> tuple[int, int]:
        """The transition of a state: (next state, by how many tokens it grows)."""
        suffix, past = self.states[state]
        suffix += symbol
        for i in range(len(suffix)):
            if past[i] is not None and suffix[i:] in self.tokens and self.follows(past[i][0], suffix[i:]):
                grown = past[i][1] + 1
                token = suffix[i:]
                break
        else:
            raise ValueError(f"no token ends in {symbol!r}")
        if symbol >= chr(FINAL):
            out = (0, grown)
        else:
            live = [suffix[i:] in self.prefixes for i in range(len(suffix))]
            at = live.index(True) if True in live else len(suffix)
            kept = tuple((past[i][0], past[i][1] - grown) if past[i] is not None and live[i] else None for i in range(at, len(suffix)))
            key = (suffix[at:], (*kept, (token, 0)))
            new = self.ids.get(key)
            if new is None:
                new = self.ids[key] = len(self.states)
                self.states.append(key)
                self.next.append({})
            out = (new, grown)
        self.next[state][symbol] = out
        return out

    def word(self, word: str) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        raw, state, count, moves = word.encode("utf-8"), 0, 0, self.next
        symbols = [self.bytes[b] for b in raw]
        symbols[-1] = self.finals[raw[-1]]
        for c in symbols:
            move = moves[state].get(c) or self.compile(state, c)
            state = move[0]
            count += move[1]
        return count

    def piece(self, piece: str) -> int:
        """Tokens of text without white space at which a chunk is cut."""
        count = self.words.get(piece)
        if count is not None:
            return count
        count = 0
        for part in self.cut_special(piece) if "<|" in piece else (piece,):
            if part in self.special:
                count += 1
            elif part:
                text = part if part.isascii() else unicodedata.normalize("NFC", part)
                text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
                count += sum(map(self.word, self.words_of(text)))
        if len(piece) <= 64:
            if len(self.words) >= MAX_WORDS:
                self.words.clear()
            self.words[piece] = count
        return count

    def text(self, text: str) -> int:
        return sum(map(self.piece, text.translate(TO_SPACE).split(" ")))

    def chunk(self, text: str) -> tuple[str, int | None, str]:
        """The map of a chunk: (head, tokens, tail), or (all of it, None, "") if
        it holds no cut."""
        first = FIRST_CUT.search(text)
        if not first:
            return text, None, ""
        start, end = first.start(), LAST_CUT.search(text).end()
        return text[:start], self.text(text[start:end]), text[end:]

    def compose(self, maps: Iterable[tuple[str, int | None, str]]) -> tuple[str, int | None, str]:
        """The map of the chunks of these maps, in their order."""
        head, count, pending = "", None, []
        for before, tokens, tail in maps:
            pending.append(before)
            if tokens is not None:
                joined, pending = "".join(pending), [tail]
                if count is None:
                    head, count = joined, tokens
                else:
                    count += self.text(joined) + tokens
        rest = "".join(pending)
        return (rest, None, "") if count is None else (head, count, rest)

    def fold(self, maps: Iterable[tuple[str, int | None, str]]) -> int:
        """Tokens of the composed maps, entered and left at the machine's start."""
        head, count, tail = self.compose(maps)
        return self.text(head) + (count or 0) + self.text(tail)


def compiled(path: str | None) -> Transducer:
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


_COMPILED: dict[str, Transducer] = {}


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""
    docs = documents(docs)

    def whole():
        machine = compiled(path)
        return lambda b: {"doc_id": b.column("doc_id"), "n_bytes": b.column("n_bytes"), "n_tokens": [machine.text(t) for t in b.column("text").to_pylist()]}

    def mapped():
        machine = compiled(path)

        def step(batch: pa.RecordBatch) -> dict:
            texts = batch.column("text").to_pylist()
            head, tokens, tail = zip(*map(machine.chunk, texts))
            return {"row": batch.column("row"), "doc_id": batch.column("doc_id"), "k": batch.column("k"), "n_bytes": [len(t.encode("utf-8")) for t in texts], "head": head, "tokens": tokens, "tail": tail}
        return step

    def composed():
        machine = compiled(path)

        def step(batch: pa.RecordBatch) -> dict:
            rows = sorted(batch.to_pylist(), key=lambda r: r["k"])
            head, tokens, tail = machine.compose((r["head"], r["tokens"], r["tail"]) for r in rows)
            return {"row": [rows[0]["row"]], "doc_id": [rows[0]["doc_id"]], "k": [rows[0]["above"]], "n_bytes": [sum(r["n_bytes"] for r in rows)], "head": [head], "tokens": [tokens], "tail": [tail]}
        return step

    def ended():
        machine = compiled(path)

        def step(batch: pa.RecordBatch) -> dict:
            maps = zip(*(batch.column(c).to_pylist() for c in ("head", "tokens", "tail")))
            return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": [machine.fold([m]) for m in maps]}
        return step

    out = "doc_id long, n_bytes long, n_tokens long"
    one = "row long, doc_id long, k int, n_bytes long, head string, tokens long, tail string"
    size = F.octet_length("text").cast("long").alias("n_bytes")
    short = map_batches(docs.where(F.length("text") <= chunk).select("doc_id", "text", size), whole, out)
    maps = map_batches(split_long(docs.where(F.length("text") > chunk), chunk, 0), mapped, one)
    covered = chunk
    while covered < 1 << 31:  # bytes, and so code points, that a string may have
        maps = map_groups(maps.withColumn("above", F.floor(F.col("k") / fan).cast("int")), ["row", "above"], composed, one)
        covered *= fan
    return short.unionByName(map_batches(maps, ended, out)).withColumn("over_limit", F.col("n_tokens") > limit)
