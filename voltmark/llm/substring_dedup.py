"""Removal of word sequences that an earlier document already has, with suffix automata.

Each window of words has an anchor: the least hash among its short runs of words. Equal windows have equal anchors, so
only anchors that stand in several documents matter, and documents are cut into passages: consecutive windows with one
anchor. Passages are dealt by anchor into bounded shards. A shard's distinct passages become a suffix automaton that knows the
first document of every sequence; the passages then stream through it, and where the match is long enough
and began in an earlier document, the window goes.

A shard goes to the passages that can match it instead of being broadcast to all documents, since that would
let every document run past every shard, which grows with the square of the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B
from voltmark.llm.scratch import Scratch

#: Words in the runs that anchors are chosen from.
RUN = 5
#: Words of passages in a shard, about.
SHARD_WORDS = 100_000
#: An anchor in more passages than this is common; its windows are dealt each by its whole self, so that no
#: shard gets all the contexts of a phrase that everyone uses.
COMMON = 1000
_WORD, _RUN, _PASSAGE = B.Spans(53), B.Spans(59), B.Spans(61)
#: Bytes of a word's hash inside a passage.
_BYTES = 5


class SuffixAutomaton:
    """All sub-sequences of the sequences added, each with the least mark of a sequence that holds it."""

    def __init__(self):
        self.length, self.link, self.next, self.mark = [0], [-1], [{}], [None]

    def _state(self, length: int, link: int, following: dict, mark) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.mark.append(mark)
        return len(self.length) - 1

    def add(self, sequence: list[int], mark: int) -> None:
        last = 0
        for symbol in sequence:
            last = self._extended(last, symbol)
            if self.mark[last] is None or mark < self.mark[last]:
                self.mark[last] = mark

    def _extended(self, last: int, symbol: int) -> int:
        length, link, following = self.length, self.link, self.next
        there = following[last].get(symbol)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, symbol, there)
        new = self._state(length[last] + 1, 0, {}, None)
        p = last
        while p >= 0 and symbol not in following[p]:
            following[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = following[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The shorter part of state q, reached from p, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]), None)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def finish(self) -> SuffixAutomaton:
        """Hands marks down to the shorter sequences; after this nothing is added."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            parent, mark = self.link[state], self.mark[state]
            if mark is not None and (self.mark[parent] is None or mark < self.mark[parent]):
                self.mark[parent] = mark
        return self

    def matching(self, sequence: list[int], most: int):
        """For each position, how long a sequence that ends there is known (up to ``most``), and its least mark."""
        state = size = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state, size = self.next[state][symbol], size + 1
            if size > most:
                size = most
            while state and self.length[self.link[state]] >= size:
                state = self.link[state]
            yield size, self.mark[state] if state else None


def _anchors(data: np.ndarray, offsets: np.ndarray, window: int):
    """Word hashes, the text of each word, first word of each window, and its anchor."""
    starts, ends, of = B.words(data, offsets, B.NOT_SPACE)
    hashes = _WORD.of_bytes(data, starts, ends)
    at = B.windows(of, window)
    run = min(RUN, window)
    first = np.arange(max(0, len(hashes) - run + 1))
    runs = _RUN.of_values(hashes, first, first + run)
    least = runs[at].copy()
    for k in range(1, window - run + 1):
        np.minimum(least, runs[at + k], out=least)
    return hashes, of, at, least


def _passages(of: np.ndarray, at: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Where a new passage begins: another text, or another anchor."""
    new = np.ones(len(at), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (of[at][1:] != of[at][:-1])
    return np.flatnonzero(new)


def _pieces(batch: pa.RecordBatch):
    data, offsets = B.texts(batch.column("text"))
    for i, j in B.pieces(offsets):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def removals(docs: DataFrame, window: int, shard_words: int = SHARD_WORDS, common: int = COMMON) -> DataFrame:
    """``doc_id, version, starts array<int>``: first words of the windows to remove, for documents that have any."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "passages")
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("version"), "text")

    def anchors(batches):
        for batch in batches:
            for i, _, piece, bounds in _pieces(batch):
                _, of, at, least = _anchors(piece, bounds, window)
                first = _passages(of, at, least)
                ids = batch.column("doc_id").take(pa.array(i + of[at[first]]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(B.signed(least[first]))], names=["doc_id", "anchor"])

    anchored = docs.mapInArrow(anchors, "doc_id long, anchor long")
    shared = scratch.store(
        anchored.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"))
        .where("low < high").select("anchor", (F.col("n") > common).alias("common"))
    )
    wanted = scratch.store(
        anchored.join(shared, "anchor").groupBy("doc_id")
        .agg(F.collect_list(F.when(~F.col("common"), F.col("anchor"))).alias("few"), F.collect_list(F.when(F.col("common"), F.col("anchor"))).alias("many"))
    )

    def cut(batches):
        for batch in batches:
            for i, j, piece, bounds in _pieces(batch):
                hashes, of, at, least = _anchors(piece, bounds, window)
                code = least ^ B.mixed(of[at].astype(np.uint64))
                few, many = (_codes(batch.column(c).slice(i, j - i)) for c in ("few", "many"))
                single = np.isin(code, many)
                first = _passages(of, at, least)
                run = np.zeros(len(at), dtype=bool)
                run[first] = True
                keep = single | np.isin(code, few)
                begin = np.flatnonzero(keep & (single | run))
                # A passage ends where the next begins; a window of a common anchor is a passage of its own.
                limit = np.append(first, len(at))[np.searchsorted(first, begin, side="right")]
                size = np.where(single[begin], 1, limit - begin) + window - 1
                start, end = at[begin], at[begin] + size
                raw = hashes.view(np.uint8).reshape(-1, 8)[:, :_BYTES].tobytes()
                # Passages may be long, so a real hash tells them apart.
                content = B.digests(np.frombuffer(raw, np.uint8), _BYTES * start, _BYTES * end, 8)[:, 0]
                words = [raw[_BYTES * a : _BYTES * b] for a, b in zip(start, end, strict=True)]
                row = pa.array(i + of[start])
                number = start - np.searchsorted(of, of[start])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(row), batch.column("version").take(row), pa.array(number.astype(np.int32)),
                        pa.array(B.signed(np.where(single[begin], content, least[begin]))), pa.array(B.signed(content)), pa.array(words, pa.binary()),
                    ],
                    names=["doc_id", "version", "start", "anchor", "content", "words"],
                )

    passages = scratch.store(
        docs.join(wanted, "doc_id").mapInArrow(cut, "doc_id long, version long, start int, anchor long, content long, words binary")
    )
    distinct = scratch.store(
        passages.groupBy("anchor", "content").agg(F.min("doc_id").alias("first"), F.first("words").alias("words"))
    )
    total = distinct.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0] // _BYTES
    shards = max(1, -(-total // shard_words))

    def match(_, table):
        words, marks = table.column("words").to_pylist(), table.column("first").to_pylist()
        firsts = [[mark] * (len(w) // _BYTES - window + 1) for w, mark in zip(words, marks, strict=True)]
        meeting = _meeting(words, window)
        automaton = SuffixAutomaton()
        for k in meeting:
            automaton.add(_symbols(words[k]), marks[k])
        automaton.finish()
        for k in meeting:
            ends = list(automaton.matching(_symbols(words[k]), window))[window - 1 :]
            firsts[k] = [mark if size >= window else None for size, mark in ends]
        return pa.table({"anchor": table.column("anchor"), "content": table.column("content"), "firsts": pa.array(firsts, pa.list_(pa.int64()))})

    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    firsts = scratch.store(dealt.groupBy("shard").applyInArrow(match, "anchor long, content long, firsts array<long>"))
    earlier = F.expr("transform(filter(transform(firsts, (f, k) -> struct(f AS f, k AS k)), x -> x.f < doc_id), x -> start + x.k)")
    found = passages.select("doc_id", "version", "start", "anchor", "content").join(firsts, ["anchor", "content"])
    starts = found.select("doc_id", "version", earlier.alias("starts")).where("size(starts) > 0")
    return starts.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def _meeting(words: list[bytes], window: int) -> np.ndarray:
    """Which passages have a window that stands twice among them. The others can match nothing but themselves,
    so the automaton needn't hold them."""
    raw = np.frombuffer(b"".join(words), np.uint8).reshape(-1, _BYTES)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, :_BYTES] = raw
    of = np.repeat(np.arange(len(words)), [len(w) // _BYTES for w in words])
    at = B.windows(of, window)
    _, place, times = np.unique(_PASSAGE.of_values(wide.view(np.uint64).ravel(), at, at + window), return_inverse=True, return_counts=True)
    return np.unique(of[at[times[place] > 1]])


def _codes(lists: pa.Array) -> np.ndarray:
    counts = lists.value_lengths().fill_null(0).to_numpy()
    of = np.repeat(np.arange(len(lists)), counts).astype(np.uint64)
    return lists.flatten().to_numpy().view(np.uint64) ^ B.mixed(of)


def _symbols(words: bytes) -> list[int]:
    wide = np.zeros((len(words) // _BYTES, 8), dtype=np.uint8)
    wide[:, :_BYTES] = np.frombuffer(words, np.uint8).reshape(-1, _BYTES)
    return wide.view(np.int64).ravel().tolist()


def deduplicated(docs: DataFrame, window: int = 13, text: bool = True) -> DataFrame:
    """``docs`` with ``text`` (the words that stay, joined by one space, unless it is not wanted), ``n_words``,
    ``n_removed``, ``kept_sha256``.

    Words are longest runs of anything but ASCII white space. A word goes if it lies in ``window`` consecutive words of its
    document whose sequence also begins in a document with a smaller ``doc_id``; all windows are judged on the texts
    as they come. Null texts have no words. Rows that repeat a ``doc_id`` are no earlier than each other;
    rows without one neither lose nor cause anything. All columns stay; those with one of the names here are replaced.
    """
    version, first_words, source_text = (B.unused(c, docs) for c in ("_version", "_starts", "_text"))
    found = removals(docs, window).toDF("doc_id", version, first_words)
    held = docs.withColumn(version, F.xxhash64("text")).join(found, ["doc_id", version], "left")
    order = [c for c in docs.columns if c != "text"]

    def compute(batch):
        texts, totals, gone, digests = [], [], [], []
        for value, starts in zip(batch.column(source_text), batch.column(first_words), strict=True):
            words = (value.as_py() or "").encode().split()
            totals.append(len(words))
            if starts.is_valid:
                change = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.unique(starts.values.to_numpy())
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                stay = np.cumsum(change[:-1]) == 0
                words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
            gone.append(totals[-1] - len(words))
            kept = b" ".join(words)
            if text:
                texts.append(kept.decode())
            digests.append(hashlib.sha256(kept).hexdigest())
        numbers = [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
        return [pa.array(texts, pa.string()), *numbers] if text else numbers

    source = held.select(*[F.col(f"`{c}`") for c in order], F.col("text").alias(source_text), first_words)
    fields = "text string, " * text + "n_words long, n_removed long, kept_sha256 string"
    return B.with_arrow(source, fields, compute, consumed=(source_text, first_words))
