"""Words and hashes of whole Arrow batches of texts, in numpy.

Texts are taken as UTF-8 bytes. A word class is a table of 256 flags; bytes from 128 on belong to
characters outside ASCII, so classes that treat all of those alike work on bytes as they do on characters.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from voltmark.llm.scratch import small_batches

#: Bytes of text that are worked on at once. A longer document makes a larger piece of its own.
PIECE_BYTES = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Digits, lower-case letters and everything outside ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def random_table(seed: int, size: int = 256) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers after which all bits depend on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Longer spans of bytes are not hashed by a polynomial: modulo a power of two it takes some long texts of two
#: alternating parts for one another whatever its base.
SHORT_BYTES = 32


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int = 16, key: bytes = b"") -> np.ndarray:
    """BLAKE2b of spans of bytes, as rows of 64-bit integers."""
    raw = data.tobytes()
    found = b"".join([blake2b(raw[a:b], digest_size=size, key=key).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
    return np.frombuffer(found, np.uint64).reshape(-1, size // 8)


class Spans:
    """Hashes of spans of a sequence: a polynomial in an odd base, from differences of running sums. Meant for short
    spans; long ones of bytes get a real hash instead."""

    def __init__(self, seed: int):
        self.key = str(seed).encode()
        self.table = random_table(seed)
        self.base = int(random_table(seed + 1, 1)[0])
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            more = len(self.up)
            step = np.uint64(pow(self.base, more, 2**64)), np.uint64(pow(self.base, -more, 2**64))
            self.up, self.down = np.concatenate([self.up, self.up * step[0]]), np.concatenate([self.down, self.down * step[1]])
        return self.up, self.down

    def of_values(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def of_bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = self.of_values(self.table[data], starts, ends)
        long = np.flatnonzero(ends - starts > SHORT_BYTES)
        if len(long):
            hashes[long] = digests(data, starts[long], ends[long], 8, self.key)[:, 0]
        return hashes


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (and the last ends). Null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes together, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word: a longest run of bytes of the class inside one text."""
    inside = word[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def windows(per_text: np.ndarray, size: int) -> np.ndarray:
    """Indices, among all words, at which a window of so many words of one text starts.
    ``per_text``: the text of each word, ascending."""
    if len(per_text) < size:
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(per_text[: len(per_text) - size + 1] == per_text[size - 1 :])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """One list for each count, over consecutive values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def unused(name: str, df: DataFrame) -> str:
    """``name``, or one made from it, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_arrow(
    df: DataFrame, fields: str, compute: Callable[[pa.RecordBatch], list[pa.Array]], consumed: Collection[str] = ()
) -> DataFrame:
    """``df`` and the columns of ``fields`` (a DDL string), which ``compute`` makes from each Arrow batch.
    A column of ``df`` with one of those names gives way to the new one. ``compute`` gets the ``consumed`` columns,
    but they are not sent back."""
    small_batches(df.sparkSession)
    new = T._parse_datatype_string(fields)
    df = df.drop(*[f.name for f in new if f.name not in consumed])
    kept = [f for f in df.schema.fields if f.name not in consumed]
    schema = T.StructType(kept + new.fields)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                back = [batch.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*back, *compute(batch)], names=schema.names)

    return df.mapInArrow(run, schema)
