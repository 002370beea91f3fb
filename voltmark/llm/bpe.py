"""Byte-pair encoding and decoding with a public vocabulary.

A pair of bytes that stands inside no token of the vocabulary can't be inside a token of any encoding, so
every such pair is a certain cut. Words are cut there first; the fragments, which are short and repeat a lot, are encoded
each for itself and their ids joined.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B
from voltmark.llm.scratch import small_batches

END = "</w>"
#: Pieces and fragments whose ids a task remembers; beyond that it starts anew.
REMEMBERED = 300_000
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
#: Fixed by the vocabulary's file: what is a word. White space only parts words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte: itself where it is
    printable in Latin-1, else the next unused one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Remembered(dict):
    """Results of a function, up to a number of them."""

    def __init__(self, compute):
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.compute(key)
        return value


@lru_cache(maxsize=1)
def loaded(definition: str) -> Bpe:
    """One encoder for all tasks of a worker, so that words are remembered from task to task."""
    return Bpe(definition)


class Bpe:
    """Encoder and decoder for a tokenizer file with words that end in ``</w>``."""

    def __init__(self, definition: str):
        """``definition``: the JSON text of the tokenizer file."""
        parts = json.loads(definition)
        vocab = parts["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in (vocab | self.special).items():
            self.tokens[i] = token
        self.vocab = vocab
        self.merges = {}
        for rank, pair in enumerate(parts["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[a, b] = rank
        self.characters = byte_characters()
        byte_of = {c: b for b, c in enumerate(self.characters)}
        self.merges_of_rank = [a + b for a, b in self.merges]
        # One flag for each pair of bytes: whether some token has it inside.
        self.inside = bytearray(1 << 16)
        for token in vocab:
            for a, b in pairwise(token.removesuffix(END)):
                if a in byte_of and b in byte_of:
                    self.inside[byte_of[a] << 8 | byte_of[b]] = 1
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.fragments = Remembered(lambda key: b"".join(i.to_bytes(4, "little") for i in self.merged(*key)))
        self.pieces = Remembered(self.piece_ids)

    def cuts(self, word: bytes) -> list[bytes]:
        """The word's fragments between certain cuts."""
        inside = self.inside
        at = [k for k, (a, b) in enumerate(pairwise(word), 1) if not inside[a << 8 | b]]
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)] if at else [word]

    def word_ids(self, word: str) -> bytes:
        *first, last = self.cuts(word.encode())
        return b"".join([self.fragments[x, False] for x in first] + [self.fragments[last, True]])

    def merged(self, fragment: bytes, ends_word: bool) -> list[int]:
        """Ids of a fragment: the pair of lowest rank is merged first, of equal ones the leftmost."""
        symbols = [self.characters[b] for b in fragment]
        if ends_word:
            symbols[-1] += END
        symbols = self._merged_short(symbols) if len(symbols) <= 32 else self._merged_long(symbols)
        return [self.vocab[s] for s in symbols if s in self.vocab]

    def _merged_short(self, symbols: list[str]) -> list[str]:
        none, rank = len(self.merges), self.merges.get
        ranks = [rank(p, none) for p in pairwise(symbols)]
        while ranks and (least := min(ranks)) < none:
            k = ranks.index(least)
            symbols[k : k + 2] = [self.merges_of_rank[least]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((symbols[k - 1], symbols[k]), none)
            if k < len(ranks):
                ranks[k] = rank((symbols[k], symbols[k + 1]), none)
        return symbols

    def _merged_long(self, symbols: list[str | None]) -> list[str]:
        """The same with a queue, for time that grows hardly more than the length."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        queue = [(self.merges[p], k, p) for k, p in enumerate(pairwise(symbols)) if p in self.merges]
        heapq.heapify(queue)
        while queue:
            _, k, pair = heapq.heappop(queue)
            n = after[k]
            if n >= len(symbols) or (symbols[k], symbols[n]) != pair:
                continue
            symbols[k], symbols[n] = pair[0] + pair[1], None
            after[k] = after[n]
            if after[k] < len(symbols):
                before[after[k]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else len(symbols)
                if right < len(symbols) and (pair := (symbols[left], symbols[right])) in self.merges:
                    heapq.heappush(queue, (self.merges[pair], left, pair))
        return [s for s in symbols if s is not None]

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        text = text or ""
        if self.special_pattern is None or "<|" not in text:
            return self.plain(text)
        parts = self.special_pattern.split(text)
        return b"".join(self.special[x].to_bytes(4, "little") if k % 2 else self.plain(x) for k, x in enumerate(parts))

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            # Each capital sigma becomes a plain small one, also at the end of a word.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        # White space parts words anyway, so the pieces between it are remembered whole. The four
        # separators that only Python takes for white space belong to words.
        pieces = WORD.findall(text) if _ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def piece_ids(self, piece: str) -> bytes:
        return b"".join(map(self.word_ids, WORD.findall(piece)))

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids, joined by spaces: this vocabulary's file has no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, tokenizer_path: str, ids: bool = True, digests: bool = True) -> DataFrame:
    """``doc_id, n_tokens`` and ``ids array<int>``, ``ids_sha256, decoded_sha256`` where asked for.

    Whole texts are encoded without special tokens around them; special tokens written in a text are recognised. Null and
    empty texts have no tokens. Rows that repeat an id each give a row. ``tokenizer_path`` is read on the
    driver; what executors get is the file's content, a few MB. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    fields = ["n_tokens long"] + ["ids array<int>"] * ids + ["ids_sha256 string, decoded_sha256 string"] * digests

    def run(batches):
        bpe = loaded(sent.value)
        for batch in (whole.slice(i, j - i) for whole in batches for i, j in B.pieces(B.texts(whole.column("text"))[1])):
            packed = [bpe.encode(t.as_py()) for t in batch.column("text")]
            counts = np.array([len(p) // 4 for p in packed], dtype=np.int64)
            columns = [batch.column("doc_id"), pa.array(counts)]
            if ids:
                columns.append(B.lists(pa.array(np.frombuffer(b"".join(packed), np.int32)), counts))
            if digests:
                columns.append(pa.array([hashlib.sha256(p).hexdigest() for p in packed]))
                columns.append(pa.array([hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed]))
            names = ["doc_id", "n_tokens", *["ids"] * ids, *["ids_sha256", "decoded_sha256"] * digests]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, " + ", ".join(fields))
