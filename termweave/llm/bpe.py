"""Byte-level BPE encoding and decoding by prefix-sharing trie traversal (operator 7).

A text is cut by the pre-tokenising pattern; the distinct words of a batch are
walked in sorted order, which visits their trie depth first. The state of a trie
node is the last token of its prefix's encoding. A child's state is the token t
that ends there and fits the state of the node where t begins: two adjacent
tokens fit if BPE on their joined bytes gives back just these two. A prefix
shared by many words is so encoded once, and a word's ids are read off by
stepping back from its node, token by token.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .textops import SLICE_BYTES, slices

#: Fixed values of byte-level BPE: the pattern that cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Distinct words and fitting pairs of tokens that a Python worker remembers; beyond, it starts afresh.
WORD_CACHE, PAIR_CACHE = 250_000, 500_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TrieEncoder:
    """One tokenizer file and the words encoded so far."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = byte_symbols()
        model = spec["model"]
        special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.vocab = {bytes(symbols[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        self.bytes_of = {i: token for token, i in self.vocab.items()} | {i: s.encode() for s, i in special.items()}
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.longest = max(map(len, self.vocab))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(symbols[c] for c in part) for part in (pair if isinstance(pair, list) else pair.split(" ")))
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.single = [self.vocab[bytes([b])] for b in range(256)]
        self.words = regex.compile(PATTERN)
        self.fitting: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def merge(self, text: bytes) -> list[int]:
        """BPE by its definition, for the few bytes of one or two tokens."""
        ids = [self.single[b] for b in text]
        while len(ids) > 1:
            (rank, new), at = min((self.merges.get(pair, (1 << 40, -1)), i) for i, pair in enumerate(zip(ids, ids[1:])))
            if new < 0:
                break
            pair, out, i = (ids[at], ids[at + 1]), [], 0
            while i < len(ids):
                if i + 1 < len(ids) and (ids[i], ids[i + 1]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _fits(self, before: int, token: int) -> bool:
        if before < 0:
            return self.merge(self.bytes_of[token]) == [token]
        return self.merge(self.bytes_of[before] + self.bytes_of[token]) == [before, token]

    def encode_words(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Ids of each word; words must be sorted, so that the trie is walked depth first."""
        vocab, fitting, longest, bytes_of = self.vocab, self.fitting, self.longest, self.bytes_of
        path, last = b"", [-1]
        for word in words:
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = vocab.get(word[start:end])
                    if token is None:
                        continue
                    key = last[start] << 20 | token
                    fit = fitting.get(key)
                    if fit is None:
                        fit = fitting[key] = self._fits(last[start], token)
                    if fit:
                        last.append(token)
                        break
            path, ids, at = word, [], len(word)
            while at:
                ids.append(last[at])
                at -= len(bytes_of[last[at]])
            yield word, ids[::-1]

    def _learn(self, words: set[str]) -> None:
        for word, ids in self.encode_words(sorted(w.encode() for w in words)):
            self.cache[word.decode()] = b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        if len(self.cache) > WORD_CACHE:
            self.cache = {}
        if len(self.fitting) > PAIR_CACHE:
            self.fitting.clear()
        out = []
        for text in texts:
            parts = self.split_special.split(text) if self.split_special else [text]
            pieces = []
            for part in parts:
                if part in self.special:
                    pieces.append(self.special[part].to_bytes(4, "little"))
                elif part:
                    pieces.append(self.words.findall(part))
            out.append(pieces)
        new = {w for pieces in out for piece in pieces if isinstance(piece, list) for w in piece} - self.cache.keys()
        self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(piece if isinstance(piece, bytes) else b"".join(map(get, piece)) for piece in pieces) for pieces in out]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")


_ENCODERS: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    """The worker's own encoder; fitting pairs and words stay for its next tasks."""
    if path not in _ENCODERS:
        if "/" in path:
            _ENCODERS[path] = TrieEncoder(path)
        else:
            import public_tokenizers

            _ENCODERS[path] = TrieEncoder(public_tokenizers.path(path))
    return _ENCODERS[path]


def encode_decode(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", size: int = SLICE_BYTES) -> DataFrame:
    """key, n_tokens, ids (little-endian uint32) and decoded (the text of those ids) for every row.

    tokenizer: the file's path, or the name of a public tokenizer's file, which is
    looked up where the work is done. A null text counts as empty: no ids, decoded
    empty. Repeated rows give repeated results; a null key stays. Other columns are
    not read. About `size` bytes of whole texts are Python objects at once.
    """
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for part, _, _ in slices(batches, "text", size):
            ids = enc.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(enc.decode, ids), pa.string())],
                ["key", "n_tokens", "ids", "decoded"],
            )

    return docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, f"key {kind.simpleString()}, n_tokens long, ids binary, decoded string").withColumnRenamed("key", key)
