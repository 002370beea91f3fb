"""Benchmark decontamination with a positional inverted index.

The index is written as segments, each over some consecutive documents: for every term the
ascending positions at which it stands. A segment answers for its own documents alone, so searching is one pass
over the segments without a shuffle. A phrase is looked for from its rarest term: that term's positions, shifted
to where the phrase would start, are intersected with the shifted positions of the next rarest, and so on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B
from voltmark.llm.scratch import Scratch

_TERM = B.Spans(23)
#: Tokens in a segment; a longer document makes a larger segment of its own.
SEGMENT_TOKENS = 1 << 18
#: Bytes of benchmark text that are sent to the executors at once; more is searched for in several passes.
QUERY_BYTES = 32 << 20
SEGMENT = "doc_ids array<long>, doc_starts binary, terms binary, first binary, positions binary"


def terms_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the text of each. Words are runs of letters, digits and
    everything outside ASCII, with A-Z lower-cased."""
    data, offsets = B.texts(column)
    hashes, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, j in B.pieces(offsets):
        piece = B.LOWER[data[offsets[i] : offsets[j]]]
        starts, ends, text = B.words(piece, offsets[i : j + 1] - offsets[i], B.ALNUM)
        hashes.append(_TERM.of_bytes(piece, starts, ends))
        of.append(text + i)
    return np.concatenate(hashes), np.concatenate(of)


def segments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    hashes, of = terms_of(batch.column("text"))
    starts = np.searchsorted(of, np.arange(batch.num_rows + 1))
    for i, j in B.pieces(starts, SEGMENT_TOKENS):
        tokens = hashes[starts[i] : starts[j]]
        order = np.argsort(tokens, kind="stable").astype(np.int32)
        ordered = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
        yield pa.RecordBatch.from_arrays(
            [
                B.lists(batch.column("doc_id")[i:j], np.array([j - i])),
                *[
                    pa.array([x.tobytes()], pa.binary())
                    for x in ((starts[i : j + 1] - starts[i]).astype(np.int32), ordered[first], np.append(first, len(ordered)).astype(np.int32), order)
                ],
            ],
            names=["doc_ids", "doc_starts", "terms", "first", "positions"],
        )


def build_index(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Segments of a positional index over all words of ``docs (doc_id, text)``, written to the shared folder.
    A null text has no words. ``segment`` numbers the segments, so a row of ``docs`` is known by that and its place,
    whatever its ``doc_id``."""

    def run(batches):
        for batch in batches:
            yield from segments(batch)

    cut = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEGMENT)
    return scratch.store(cut.select(F.monotonically_increasing_id().alias("segment"), *cut.columns))


@dataclass
class Segment:
    doc_ids: np.ndarray
    doc_starts: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    positions: np.ndarray

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.first[term] : self.first[term + 1]]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_starts, positions, side="right") - 1


@dataclass
class Phrases:
    """Windows of consecutive words of items: ``words[window]`` and the item of each. Windows of one length
    only; items with fewer words come in other groups."""

    size: int
    words: np.ndarray
    item: np.ndarray


def phrases(column, window: int) -> list[Phrases]:
    """All windows of ``window`` words of each item, once for each item; a shorter item that has words is one window."""
    hashes, of = terms_of(column)
    counts = np.bincount(of, minlength=len(column))
    groups = []
    for size in sorted({int(min(c, window)) for c in counts if c}):
        at = B.windows(of, size)
        at = at[counts[of[at]] >= window if size == window else counts[of[at]] == size]
        rows = np.unique(np.column_stack([of[at].astype(np.uint64), hashes[at[:, None] + np.arange(size)]]), axis=0)
        groups.append(Phrases(size, rows[:, 1:], rows[:, 0].astype(np.int64)))
    return groups


def occurrences(segment: Segment, group: Phrases, slop: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """``item, starts`` for each window that occurs. With ``slop`` the words may stand in any order within
    ``size + slop`` words of a document; a start is then where the earliest of them stands."""
    if not len(segment.terms):
        return
    known = np.minimum(np.searchsorted(segment.terms, group.words), len(segment.terms) - 1)
    counts = np.where(segment.terms[known] == group.words, np.diff(segment.first)[known], 0)
    for k in np.flatnonzero(counts.min(axis=1) > 0):
        rarest_first = np.argsort(counts[k], kind="stable")
        anchor = rarest_first[0]
        if slop:
            starts = _near(segment, known[k], anchor, group.size + slop)
        else:
            starts = segment.postings(known[k, anchor]) - np.int32(anchor)
            for offset in rarest_first[1:]:
                other = segment.postings(known[k, offset])
                at = np.minimum(np.searchsorted(other, starts + offset), len(other) - 1)
                starts = starts[other[at] == starts + offset]
                if not len(starts):
                    break
            starts = starts[starts >= 0]
            starts = starts[segment.document(starts) == segment.document(starts + group.size - 1)] if len(starts) else starts
        if len(starts):
            yield int(group.item[k]), starts


def _near(segment: Segment, terms: np.ndarray, anchor: int, reach: int) -> np.ndarray:
    """Starts of stretches of ``reach`` words of one document that hold all terms, as often as the window does."""
    distinct, times = np.unique(terms, return_counts=True)
    found = []
    for at in segment.postings(terms[anchor]):
        doc = segment.document(np.array([at]))[0]
        low, high = max(segment.doc_starts[doc], at - reach + 1), min(segment.doc_starts[doc + 1], at + reach) - 1
        lists = [p[np.searchsorted(p, low) : np.searchsorted(p, high, side="right")] for p in map(segment.postings, distinct)]
        for start in np.unique(np.concatenate(lists)):
            if low <= start <= at and all(
                np.searchsorted(p, start + reach) - np.searchsorted(p, start) >= n for p, n in zip(lists, times, strict=True)
            ):
                found.append(start)
    return np.unique(np.array(found, dtype=np.int64))


ROW = "segment long, place int"
HITS = "doc_id long, n_words long, hits array<struct<item_id:long,start:int,length:int>>"
VERDICTS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def search(index: DataFrame, items: DataFrame, window: int = 10, slop: int = 0) -> DataFrame:
    """``doc_id, n_words, hits array<struct<item_id, start, length>>`` for every indexed document.

    ``items (item_id long, text string)`` are cut into windows of ``window`` words (fewer words: one window;
    none: nothing). A hit is a run of words of the document that equals a window; with ``slop`` it is a stretch of
    ``window + slop`` words that holds them all in any order. Items are sent out in groups of at most ``QUERY_BYTES``.
    """
    return _merged(index, _blocks(items), window, slop).select("doc_id", "n_words", "hits")


def _merged(index: DataFrame, blocks: list[pa.Table], window: int, slop: int) -> DataFrame:
    """Hits of all passes for every indexed row, which is known by its segment and place in it."""
    results = [_search(index, sent, window, slop, _hits, HITS) for sent in blocks]
    if len(results) == 1:
        return results[0]
    found = reduce(DataFrame.unionByName, results).groupBy("segment", "place", "doc_id", "n_words")
    return found.agg(F.flatten(F.collect_list("hits")).alias("hits"))


def _blocks(items: DataFrame) -> list[pa.Table]:
    """All items in parts of bounded size, split by a hash."""
    items = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // (QUERY_BYTES // 2)))
    blocked = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    return [blocked.where(F.col("block") == b).drop("block").toArrow() for b in range(blocks)]


def _search(index: DataFrame, items: pa.Table, window: int, slop: int, answer, schema: str) -> DataFrame:
    """One pass over the segments; ``answer`` makes the rows of a segment from its hits, by document. The rows
    have the columns of ``ROW`` first."""
    schema = f"{ROW}, {schema}"
    groups = phrases(items.column("text"), window)
    names = items.column("item_id").to_numpy()
    sent = index.sparkSession.sparkContext.broadcast((groups, names))

    def run(batches):
        groups, names = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("doc_ids")[row].values
                starts, terms, first, positions = (
                    np.frombuffer(batch.column(c)[row].as_buffer(), kind)
                    for c, kind in (("doc_starts", np.int32), ("terms", np.uint64), ("first", np.int32), ("positions", np.int32))
                )
                segment = Segment(ids.to_numpy(zero_copy_only=False), starts, terms, first, positions)
                parts = [[np.zeros(0, np.int64)] * 4]
                for group in groups:
                    length = group.size + slop
                    for item, at in occurrences(segment, group, slop):
                        parts.append([segment.document(at), np.full(len(at), names[item]), at, np.full(len(at), length)])
                doc, item, at, length = (np.concatenate(p) for p in zip(*parts, strict=True))
                order = np.lexsort((at, item, doc))
                doc, item, at = doc[order], item[order], at[order]
                length = np.minimum(at + length[order], starts[doc + 1]) - at
                n = len(starts) - 1
                columns = [pa.array(np.full(n, batch.column("segment")[row].as_py())), pa.array(np.arange(n, dtype=np.int32))]
                columns += [ids, pa.array(np.diff(starts).astype(np.int64))]
                columns += answer(n, doc, item, at - starts[doc], length)
                yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in schema.split(", ")])

    return index.mapInArrow(run, schema)


def _hits(n: int, doc: np.ndarray, item: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[pa.Array]:
    hits = [pa.array(item, pa.int64()), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32))]
    return [B.lists(pa.StructArray.from_arrays(hits, names=["item_id", "start", "length"]), np.bincount(doc, minlength=n))]


def _verdicts(n: int, doc: np.ndarray, item: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[pa.Array]:
    bounds = np.searchsorted(doc, np.arange(n + 1))
    n_hit, n_items, digests = [], [], []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        ids = sorted(map(str, np.unique(item[a:b])))
        n_items.append(len(ids))
        digests.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        if a == b:
            n_hit.append(0)
            continue
        change = np.zeros(int((start[a:b] + length[a:b]).max()) + 1, dtype=np.int64)
        np.add.at(change, start[a:b], 1)
        np.add.at(change, start[a:b] + length[a:b], -1)
        n_hit.append(int((np.cumsum(change) > 0).sum()))
    return [pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(digests, pa.string()), pa.array([k > 0 for k in n_hit], pa.bool_())]


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs (doc_id, text)``.

    A word is hit if it lies inside an occurrence of a window of ``items`` (see ``search``). ``items_sha256`` is
    of the items that occur, sorted as strings and joined by commas. Null and empty texts have no words and
    are clean; items without words or id occur nowhere. Every row is judged for itself,
    also where rows repeat a ``doc_id`` or have none. Other columns are ignored.
    """
    index = build_index(docs, Scratch(docs.sparkSession, "index"))
    blocks = _blocks(items)
    columns = [c.split(" ")[0] for c in VERDICTS.split(", ")]
    if len(blocks) == 1:
        return _search(index, blocks[0], window, 0, _verdicts, VERDICTS).select(*columns)

    def verdicts(batches):
        for batch in batches:
            column = batch.column("hits")
            hits, counts = column.flatten(), column.value_lengths().to_numpy()
            doc = np.repeat(np.arange(batch.num_rows), counts)
            item, start, length = (hits.field(k).to_numpy() for k in range(3))
            judged = _verdicts(batch.num_rows, doc, item, start, length)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), *judged], names=columns)

    return _merged(index, blocks, window, 0).select("doc_id", "n_words", "hits").mapInArrow(verdicts, VERDICTS)
