"""Line deduplication over a whole corpus.

Every long line leaves a 128-bit hash (BLAKE2b: equal hashes mean equal lines). The hashes are range-partitioned and sorted by hash, then document,
so one stream through a partition meets all documents of a line one after another and holds the lines of a few
documents at most. What comes out are not texts but compressed bitmaps: for each document, which lines stay.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B
from voltmark.llm.scratch import Scratch

_NEWLINE = 10


def long_lines(batch: pa.RecordBatch, min_chars: int) -> pa.RecordBatch:
    """A row for every line of at least ``min_chars`` code points: hash of its key, document, line number."""
    data, offsets = B.texts(batch.column("text"))
    ids, versions = batch.column("doc_id"), batch.column("version")
    parts = []
    for i, j in B.pieces(offsets):
        piece, starts_of = B.LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        breaks = np.flatnonzero(piece == _NEWLINE)
        # Each text has a line more than it has breaks; an empty text has an empty line.
        starts, ends = np.sort(np.concatenate([starts_of[:-1], breaks + 1])), np.sort(np.concatenate([breaks, starts_of[1:]]))
        text = np.repeat(np.arange(j - i), np.diff(np.searchsorted(breaks, starts_of)) + 1)
        number = np.arange(len(starts)) - np.searchsorted(text, text)
        solid = np.flatnonzero(B.NOT_SPACE[piece])
        if not len(solid):
            continue
        left = np.searchsorted(solid, starts)
        right = np.searchsorted(solid, ends) - 1
        some = np.flatnonzero(left <= right)
        starts, ends = solid[left[some]], solid[right[some]] + 1
        chars = np.concatenate([[0], np.cumsum((piece & 0xC0) != 0x80)])
        long = np.flatnonzero(chars[ends] - chars[starts] >= min_chars)
        starts, ends, rows = starts[long], ends[long], some[long]
        hashes = B.digests(piece, starts, ends)
        parts.append([hashes[:, 0], hashes[:, 1], i + text[rows], number[rows]])
    h1, h2, row, number = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.uint64) for k in range(4))
    row = pa.array(row.astype(np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array(B.signed(h1)), pa.array(B.signed(h2)), ids.take(row), versions.take(row), pa.array(number.astype(np.int32))],
        names=["h1", "h2", "doc_id", "version", "line"],
    )


def repeats(rows: Iterable[tuple], min_docs: int) -> Iterator[tuple]:
    """Streams ``(h1, h2, doc_id, version, line)``, sorted by hash and then by falling ``doc_id``.

    Yields ``(h1, h2, doc_id, version, line, n_docs)``: a line to drop has no hash and no count. The first and
    the last hash may go on in another partition; for those, what can't be decided here (the largest document, and all while
    they are too few) is left open and comes with its hash, and one row with ``n_docs`` tells how many documents were seen and the
    largest. No more than the lines of ``min_docs`` documents are held.
    """
    key = top = last = None
    n, kept, waiting, first = 0, [], [], True

    def close(edge: bool):
        if edge and key is not None:
            yield (*key, top, None, None, n)
            for doc, version, line in kept + waiting:
                yield (*key, doc, version, line, None)

    for h1, h2, doc, version, line in rows:
        if (h1, h2) != key:
            yield from close(first)
            first = key is None
            key, top, last, n, kept, waiting = (h1, h2), doc, None, 0, [], []
        if doc != last:
            n, last = n + 1, doc
            if n == min_docs:
                for held in waiting:
                    yield (None, None, *held, None)
                waiting = []
        if doc == top:
            kept.append((doc, version, line))
        elif n < min_docs:
            waiting.append((doc, version, line))
        else:
            yield (None, None, doc, version, line, None)
    yield from close(True)


def keep_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Which lines of each document stay: ``doc_id, version, keep``, for the documents that lose any.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at least
    ``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines but those in the
    largest ``doc_id`` that holds them. ``keep`` is zlib-compressed bits, the first line at the highest bit;
    lines after the last bit stay. ``version`` is a hash of the text.

    Null and empty texts are one empty line. Rows that repeat a ``doc_id`` count as one document; rows
    without one lose nothing and count for nothing. Other columns than ``doc_id`` and ``text`` are ignored.
    """
    schema = "h1 long, h2 long, doc_id long, version long, line int"
    scratch = Scratch(docs.sparkSession, "lines")

    def lines(batches):
        for batch in batches:
            yield long_lines(batch, min_chars)

    def stream(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        names, block = ["h1", "h2", "doc_id", "version", "line", "n_docs"], []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for row in repeats(rows(), min_docs):
            block.append(row)
            if len(block) == 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds, strict=True)], names=names)
                block = []
        if block:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*block), kinds, strict=True)], names=names)

    found = scratch.store(docs_with_version(docs).where("doc_id IS NOT NULL").mapInArrow(lines, schema))
    # The document is part of the range, so a line of very many documents is dealt over many tasks.
    dealt = found.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", F.desc("doc_id"), "version", "line")
    seen = scratch.store(dealt.mapInArrow(stream, schema + ", n_docs long"))
    # At most two hashes a partition: this table grows with the number of partitions alone.
    edges = (
        seen.where("n_docs IS NOT NULL").groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("docs"), F.max("doc_id").alias("top")).where(F.col("docs") >= min_docs)
    )
    late = seen.where("h1 IS NOT NULL AND n_docs IS NULL").join(edges, ["h1", "h2"]).where("doc_id < top")
    drops = seen.where("h1 IS NULL").select("doc_id", "version", "line").unionByName(late.select("doc_id", "version", "line"))
    dropped = drops.groupBy("doc_id", "version").agg(F.collect_set("line").alias("lines"))

    def bitmaps(batches):
        for batch in batches:
            keep = [bitmap(x.values.to_numpy()) for x in batch.column("lines")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(keep, pa.binary())], names=["doc_id", "version", "keep"])

    return dropped.mapInArrow(bitmaps, "doc_id long, version long, keep binary")


def bitmap(dropped: np.ndarray) -> bytes:
    bits = np.ones(int(dropped.max()) // 8 * 8 + 8, dtype=np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def split_kept(text: str | None, keep: bytes | None) -> tuple[list[str], int]:
    """The lines that stay, and how many there were."""
    lines = (text or "").split("\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)].tolist()
    return [x for k, x in enumerate(lines) if k >= len(bits) or bits[k]], len(lines)


def docs_with_version(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("version"))


def deduplicated(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, text: bool = True) -> DataFrame:
    """``docs`` with the lines that stay as ``text`` (unless it is not wanted), and ``n_lines``, ``n_dropped``, ``kept_sha256``.

    See ``keep_bitmaps``. All columns of ``docs`` are kept; those with one of the names given here are replaced.
    A null text becomes an empty one.
    """
    version, kept_lines, source_text = (B.unused(c, docs) for c in ("_version", "_keep", "_text"))
    bitmaps = keep_bitmaps(docs, min_chars, min_docs).toDF("doc_id", version, kept_lines)
    held = docs.withColumn(version, F.xxhash64("text")).join(bitmaps, ["doc_id", version], "left")
    order = [c for c in docs.columns if c != "text"]

    def compute(batch):
        texts, totals, drops, digests = [], [], [], []
        for value, keep in zip(batch.column(source_text), batch.column(kept_lines), strict=True):
            lines, total = split_kept(value.as_py(), keep.as_py())
            kept = "\n".join(lines)
            if text:
                texts.append(kept)
            totals.append(total)
            drops.append(total - len(lines))
            digests.append(hashlib.sha256(kept.encode()).hexdigest())
        numbers = [pa.array(totals, pa.int64()), pa.array(drops, pa.int64()), pa.array(digests, pa.string())]
        return [pa.array(texts, pa.string()), *numbers] if text else numbers

    fields = "text string, " * text + "n_lines long, n_dropped long, kept_sha256 string"
    source = held.select(*[F.col(f"`{c}`") for c in order], F.col("text").alias(source_text), kept_lines)
    return B.with_arrow(source, fields, compute, consumed=(source_text, kept_lines))
