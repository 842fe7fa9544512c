"""BPE encoding and decoding (operator 6): a tokenization automaton built by merge gadgets.

The automaton reads tokens. At first every base symbol may follow every other. Each merge rule, in order
of priority, applies one gadget for (u, v) -> w:

* after u, the arc v is cut (from now on u and v would have merged);
* a new arc w leaves from every state that has the arc u just now, if after u the arc v still exists;
* the state after w is the state after v just now.

What remains after the last rule accepts, for each string, its BPE tokenization and nothing else.
States share their arcs: the state after a token is a view of another token's state as of the rule that
made it, plus its own cuts. So the automaton has one entry per rule, and an arc is looked up by
following two short chains. Looked-up arcs are kept in a transition table.

Encoding runs over the bytes of a pre-split word, from state to state by the table. Decoding emits the labels (bytes) of the tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

# Fixed value: the vocabulary's pre-tokenization, as its file's ByteLevel step states it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT_WORDS = 1_000_000      # words whose tokens a worker remembers (some 200 MB); the memory is emptied when full
KEPT_ARCS = 1_000_000
ROWS_AT_ONCE = 256


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file: printable Latin-1
    characters stand for themselves, the other bytes for the letters from U+0100 on."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class TokenAutomaton:
    """Built from token labels (bytes by id) and merge rules (pairs of labels in order of priority)."""

    def __init__(self, labels: dict[int, bytes], rules: list[tuple[bytes, bytes]]):
        self.labels = labels
        ids = {label: i for i, label in labels.items()}
        self.cut: dict[tuple[int, int], int] = {}           # (u, v) -> the rule that cut the arc v after u
        self.born: dict[int, tuple[int, int, int]] = {}     # w -> (rule, u, v)
        self.table: dict[tuple[int, int], bool] = {}
        self.live = {ids[bytes([b])]: True for b in range(256) if bytes([b]) in ids}
        for time, (a, b) in enumerate(rules):
            u, v = ids[a], ids[b]
            w = ids[a + b]
            exists = u in self.live and v in self.live and self.has_arc(u, v)
            self.cut[u, v] = time
            if exists and w not in self.live:
                self.born[w] = (time, u, v)
                self.live[w] = True
        self.table.clear()
        self.ids = {labels[t]: t for t in self.live}
        self.reach: dict[bytes, int] = {}       # the longest label that begins with these two bytes
        for label in self.ids:
            self.reach[label[:2]] = max(len(label), self.reach.get(label[:2], 1))

    def has_arc(self, a: int, b: int) -> bool:
        """May b follow a? Follows a to the states its state is a view of, and b to the arcs its arc came from;
        a cut counts if it came before the view was taken and no later than the arc's birth."""
        before = 1 << 60
        while True:
            upto, x = 1 << 60, b
            while True:
                t = self.cut.get((a, x))
                if t is not None and t < before and t <= upto:
                    return False
                made = self.born.get(x)
                if made is None:
                    break
                upto, x = min(upto, made[0]), made[1]
            made = self.born.get(a)
            if made is None:
                return True
            before, a = min(before, made[0]), made[2]

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: the one path through the automaton that reads all its bytes.

        Arcs are tried from the longest label down. A state from which the rest cannot be read is marked, so
        that no (position, token) is left twice.
        """
        ids, table, reach, n = self.ids, self.table, self.reach, len(word)
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        out: list[int] = []
        path: list[tuple[int, int, int]] = []
        dead: set[tuple[int, int]] = set()
        at, last, size = 0, -1, min(n, reach.get(word[:2], 1))
        while at < n:
            while size:
                t = ids.get(word[at:at + size])
                if t is not None:
                    if last < 0:
                        ok = True
                    else:
                        arc = (last, t)
                        ok = table.get(arc)
                        if ok is None:
                            if len(table) >= KEPT_ARCS:
                                table.clear()
                            ok = table[arc] = self.has_arc(last, t)
                    if ok and not (dead and (at + size, t) in dead):
                        break
                size -= 1
            if size:
                path.append((at, last, size))
                out.append(t)
                at, last = at + size, t
                size = min(n - at, reach.get(word[at:at + 2], 1))
            else:
                dead.add((at, last))
                at, last, size = path.pop()
                out.pop()
                size -= 1
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


class _NotCut(Exception):
    """A chunk with white space beside the space before or after it."""


class _Chunks(dict):
    """The tokens of chunks that have been met, by the chunk without the space before it; others are found when asked for."""

    def __init__(self, words):
        self.words = words

    def __missing__(self, c: str) -> bytes:
        if not c or c[0].isspace() or c[-1].isspace():
            raise _NotCut
        got = self.words(" " + c)
        if len(c) <= 24:
            self.keep(c, got)
        return got

    def keep(self, c: str, got: bytes) -> None:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[c] = got


class Tokenizer:
    """A byte-level vocabulary file: its special tokens, its word split and its automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        labels = {i: raw(s) for s, i in spec["model"]["vocab"].items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton = TokenAutomaton(labels, [(raw(a), raw(b)) for a, b in pairs])
        self.automaton.labels = labels | {i: s.encode() for s, i in self.special.items()}
        self.words = regex.compile(SPLIT)
        names = sorted(self.special, key=len, reverse=True)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.known: dict[str, bytes] = {}
        self.chunks = _Chunks(self._words)
        self.label_bytes = pa.array([self.automaton.labels.get(i, b"") for i in range(max(self.automaton.labels) + 1)], pa.binary())

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian 32-bit numbers."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for part in self.parts.split(text):
            out.append(np.int32(self.special[part]).tobytes() if part in self.special else self._plain(part))
        return b"".join(out)

    def _plain(self, text: str) -> bytes:
        """Cut before each space that stands between two other characters: the word split always cuts there,
        so each chunk has its own tokens. Texts with other white space beside a space are not cut."""
        first, *rest = text.split(" ")
        if first[-1:].isspace():
            return self._words(text)
        try:
            return b"".join([self._words(first), *map(self.chunks.__getitem__, rest)])
        except _NotCut:
            return self._words(text)

    def _words(self, text: str) -> bytes:
        """Tokens of the words of the text, each from the automaton or from memory. A word with a space before it is a chunk."""
        out, known, chunks = [], self.known, self.chunks
        for w in self.words.findall(text):
            got = chunks.get(w[1:]) if w[0] == " " else known.get(w)
            if got is None:
                got = np.array(self.automaton.encode(w.encode()), np.int32).tobytes()
                if len(w) <= 24 and w[0] != " ":
                    if len(known) >= KEPT_WORDS:
                        known.clear()
                    known[w] = got
                elif len(w) <= 24 and not w.isspace():
                    chunks.keep(w[1:], got)
            out.append(got)
        return b"".join(out)

    def decode(self, ids) -> str:
        return self.automaton.decode(ids).decode("utf-8", errors="replace")

    def decode_all(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of many documents at once: document k has the ids from ``offsets[k]`` to ``offsets[k + 1]``.

        The labels of all ids, taken in their order, lie in one buffer, of which each text is a stretch. Where this is no valid
        UTF-8, or too long for one array, each document is decoded alone."""
        try:
            taken = self.label_bytes.take(pa.array(ids))
            ends = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset:taken.offset + len(ids) + 1]
            texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends[offsets]), taken.buffers()[2])
            texts.validate(full=True)
            return texts
        except pa.ArrowInvalid:
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, built once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def _encode_batches(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                coded = [np.frombuffer(tok.encode(t or ""), np.int32) for t in batch.column("text").to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int32)
                flat = np.concatenate(coded)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                columns = [batch.column("row"), ids]
                if decode:
                    columns.append(tok.decode_all(offsets, flat))
                yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"][:len(columns)])
    return run


def encode_documents(docs: DataFrame, path: str, carry: list[str], decode: bool = False) -> DataFrame:
    """The ``carry`` columns of ``docs`` as a struct ``row``, the token ``ids`` of the whole text, and, if wanted,
    the text ``decoded`` from these ids.

    Special tokens in a text are encoded as such, as the file's own library does by default. Null and
    empty texts have no tokens and decode to the empty string. Every row gives one row, in place:
    nothing is shuffled. Very long texts are encoded whole. An empty table gives an empty result. No
    column name can clash, since the input's columns stay inside ``row``.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "text")
    fields = [T.StructField("row", df.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if decode:
        fields.append(T.StructField("decoded", T.StringType()))
    return df.mapInArrow(_encode_batches(path, decode), T.StructType(fields))
