"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no token of the vocabulary can never be joined
by a merge, so every such pair is a certain cut. Each pre-token is cut there,
the fragments are encoded on their own by the vocabulary's merges, and the ids
are concatenated. Recent pre-tokens are remembered in bounded tables of each
worker process.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; the special token's string in a text is that token, as the tokenizers
library has it; repeated rows are encoded each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: Fixed by the vocabulary: its pre-token pattern.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
            r"|\s+(?!\S)|\s+")
#: The same pattern for texts below U+0100, with its classes spelt out.
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
PLAIN_PRETOKEN = (rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+"
                  rf"|[{_S}]+(?![^{_S}])|[{_S}]+")
#: Entries that each table of a worker may hold before it starts anew.
MEMORY_ENTRIES = 150_000


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ForcedBoundaryBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: b for b, c in byte_letters().items()}
        as_bytes = lambda s: bytes(to_byte[c] for c in s)
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.token_bytes = {i: t for t, i in self.ids.items()}
        self.token_bytes.update({i: s.encode() for s, i in self.special.items()})
        joined = np.zeros((256, 256), dtype=bool)
        for token in self.ids:
            if len(token) > 1:
                raw = np.frombuffer(token, np.uint8)
                joined[raw[:-1], raw[1:]] = True
        self.joined = joined
        self._pairs = [row.tobytes() for row in joined]
        self.model = Tokenizer.from_file(path).model
        self._letters = list(map(byte_letters().__getitem__, range(256)))
        self.pattern = regex.compile(PRETOKEN)
        self.plain = re.compile(PLAIN_PRETOKEN)
        self.specials = (regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None)
        self._pieces: dict[str, tuple[int, str, bytes]] = {}
        self._older: dict[str, tuple[int, str, bytes]] = {}

    def fragments(self, piece: bytes) -> list[bytes]:
        """Cut a pre-token at every byte pair that no token holds."""
        out, start, pairs = [], 0, self._pairs
        for i in range(1, len(piece)):
            if not pairs[piece[i - 1]][piece[i]]:
                out.append(piece[start:i])
                start = i
        out.append(piece[start:])
        return out

    def encode_fragment(self, fragment: bytes) -> tuple[int, ...]:
        """Ids of one fragment, by the vocabulary's merges alone (no pre-tokens)."""
        if fragment.isalpha():
            letters = fragment.decode("ascii")
        else:
            letters = "".join(map(self._letters.__getitem__, fragment))
        return tuple(t.id for t in self.model.tokenize(letters))

    def piece_ids(self, piece: str) -> list[int]:
        found = []
        for fragment in self.fragments(piece.encode()):
            found += self.encode_fragment(fragment)
        return found

    def split(self, span: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        plain = span.isascii() or max(span) < "\u0100"
        return (self.plain if plain else self.pattern).findall(span)

    def _spans(self, text: str):
        if self.specials is None:
            return [(text, False)]
        return [(s, k % 2 == 1) for k, s in enumerate(self.specials.split(text)) if s]

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for span, special in self._spans(text or ""):
            if special:
                ids.append(self.special[span])
            else:
                for piece in self.split(span):
                    ids += self.piece_ids(piece)
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the joined ids, SHA-256 of the decoded text."""
        count, parts, decoded, known = 0, [], [], self._pieces
        for span, special in self._spans(text or ""):
            pieces = [span] if special else self.split(span)
            for piece in pieces:
                got = known.get(piece)
                if got is None:
                    got = self._older.get(piece)
                    if got is None:
                        ids = [self.special[span]] if special else self.piece_ids(piece)
                        got = (len(ids), ",".join(map(str, ids)),
                               b"".join(map(self.token_bytes.__getitem__, ids)))
                    if len(piece) <= 64:
                        if len(known) >= MEMORY_ENTRIES:
                            self._older, self._pieces = known, {}
                            known = self._pieces
                        known[piece] = got
                count += got[0]
                parts.append(got[1])
                decoded.append(got[2])
        back = b"".join(decoded).decode("utf-8", "replace")
        return (count, hashlib.sha256(",".join(parts).encode()).hexdigest(),
                hashlib.sha256(back.encode()).hexdigest())


_loaded: dict[str, ForcedBoundaryBpe] = {}


def load(path: str) -> ForcedBoundaryBpe:
    """The vocabulary, read once in each worker process."""
    if path not in _loaded:
        _loaded[path] = ForcedBoundaryBpe(path)
    return _loaded[path]


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the ids of every text, as an array."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        bpe = load(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([bpe.encode(t) for t in part.column(1).to_pylist()],
                                              pa.list_(pa.int32()))], [key, "ids"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text of every id array; a null array gives the empty text."""
    kind = encoded.schema[key].dataType.simpleString()

    def run(batches):
        bpe = load(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([bpe.decode(x or []) for x in
                                               part.column(1).to_pylist()], pa.string())],
                    [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def digests(docs: DataFrame, vocabulary: str, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """Encode and decode every text: id count and digests of the ids and of the round trip."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        bpe = load(vocabulary)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                found = [bpe.digest(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.string()),
                     pa.array([f[2] for f in found], pa.string())],
                    [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
