"""Near-duplicate embeddings by products of tiles of dequantised int8 codes with rigorous error bounds.

Unit vectors are rounded to 8-bit codes times a scale, and each keeps the norm of what rounding took away. From the
product of two codes and the two norms follows an upper bound of the cosine. Blocks of vectors meet tile by
tile; only pairs whose bound reaches the threshold are computed again, in double precision from the full vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltmark.llm.components import Forest, components
from voltmark.llm.scratch import Scratch

#: Distinct vectors in a block; a task holds two blocks.
BLOCK_ROWS = 4096
_TILE_ROWS, _PAIRS_AT_ONCE = 512, 100_000
#: Products of codes up to 127 of so many parts are below 2^24, so their sum is exact in single precision.
_EXACT_PARTS = 1024
#: Covers what single precision loses when scales and error terms are applied: a few roundings of numbers up to 2.
_SLACK = 2e-6


def packed(column: pa.Array, kind: str) -> list[bytes | None]:
    """The bytes of each vector; none for null, empty and zero vectors and those with null or non-finite parts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    parts = column.flatten()
    values = parts.to_numpy(zero_copy_only=False).astype(kind)  # null becomes NaN
    starts = np.concatenate([[0], np.cumsum(lengths)])
    result: list[bytes | None] = [None] * len(column)
    for size in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == size)
        matrix = values[starts[rows][:, None] + np.arange(size)]
        largest = np.abs(matrix.astype(np.float64)).max(axis=1)
        for k in np.flatnonzero(np.isfinite(largest) & (largest > 0)):
            result[rows[k]] = matrix[k].tobytes()
    return result


class Block:
    """Full vectors, weights and ids of some rows, and their codes."""

    def __init__(self, table: pa.Table, kind: str):
        self.ids = table.column("rep").to_numpy()
        self.weights = table.column("weight").to_numpy().astype(np.float64)
        raw = b"".join(table.column("packed").to_pylist())
        full = np.frombuffer(raw, kind).reshape(len(self.ids), -1).astype(np.float64)
        # Powers of two change no digit, and squares neither over- nor underflow afterwards.
        self.full = np.ldexp(full, -np.frexp(np.abs(full).max(axis=1))[1][:, None])
        self.norms = np.sqrt((self.full**2).sum(axis=1))
        unit = self.full / self.norms[:, None]
        self.codes, self.scales, self.errors = quantised(unit)
        rounded = self.codes * self.scales[:, None]
        self.sizes = np.sqrt((rounded**2).sum(axis=1))

    def bounds(self, rows: slice, other: Block, first: int) -> np.ndarray:
        """Upper bounds of the cosines of some rows with those of ``other`` from ``first`` on: the product of the codes, exact,
        times the scales, and what the rounding errors of either side can add."""
        parts = self.codes.shape[1]
        product = None
        for k in range(0, parts, _EXACT_PARTS):
            part = self.codes[rows, k : k + _EXACT_PARTS].astype(np.float32) @ other.codes[first:, k : k + _EXACT_PARTS].astype(np.float32).T
            product = part if product is None else product.astype(np.float64) + part
        product *= self.scales[rows, None].astype(product.dtype)
        product *= other.scales[None, first:].astype(product.dtype)
        mine = np.column_stack([self.errors, self.sizes])[rows].astype(np.float32)
        others = np.column_stack([other.sizes + other.errors, other.errors])[first:].astype(np.float32)
        product += mine @ others.T
        return product

    def cosines(self, rows: np.ndarray, other: Block, columns: np.ndarray) -> np.ndarray:
        return (self.full[rows] * other.full[columns]).sum(axis=1) / (self.norms[rows] * other.norms[columns])


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes from -127 to 127, the scale of each row, and the norm of the difference that rounding leaves."""
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    return codes, scales, np.sqrt(((unit - codes * scales[:, None]) ** 2).sum(axis=1))


def linked(x: Block, y: Block | None, threshold: float) -> tuple[np.ndarray, np.ndarray, Forest]:
    """Weights of what each row of ``x`` and of ``y`` is linked with, and the components over ``x`` then ``y``.
    Without ``y`` the pairs of ``x`` with itself."""
    other = x if y is None else y
    nx, ny = len(x.ids), len(other.ids)
    links_x, links_y = np.zeros(nx), np.zeros(ny)
    forest = Forest(nx + (0 if y is None else ny))
    for top in range(0, nx, _TILE_ROWS):
        first = top if y is None else 0
        rows, columns = np.nonzero(x.bounds(slice(top, top + _TILE_ROWS), other, first) >= threshold - _SLACK)
        rows, columns = rows + top, columns + first
        if y is None:
            rows, columns = rows[rows < columns], columns[rows < columns]
        for k in range(0, len(rows), _PAIRS_AT_ONCE):
            r, c = rows[k : k + _PAIRS_AT_ONCE], columns[k : k + _PAIRS_AT_ONCE]
            keep = x.cosines(r, other, c) >= threshold
            r, c = r[keep], c[keep]
            links_x += np.bincount(r, other.weights[c], nx)
            links_y += np.bincount(c, x.weights[r], ny)
            forest.add(r, c if y is None else c + nx)
    if y is None:
        links_x, links_y = links_x + links_y, np.zeros(0)
    return links_x, links_y, forest


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors (vec_id long, embedding array<float or double>)``.

    Two vectors of one length are linked if their cosine in double precision is at least ``threshold``. Null, empty and zero
    vectors and those with null or non-finite parts are linked with nothing; so are rows without ``vec_id``, which
    have no component and are kept. Equal vectors are one class with a weight, so copies cost nothing.
    Ids are taken to be unique: rows that share one are one vertex, with the links of all their vectors. Other columns are ignored.

    Every pair of blocks of ``block_rows`` distinct vectors meets in one task, which returns a link count for a row and a forest of
    links, never the pairs. Each vector is sent once for each block there is: the work grows with the square
    of the number of *distinct* vectors, which is what comparing all of them by tile products means.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    kind = "<f4" if single else "<f8"
    vectors = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>")
    )

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed(batch.column(1), kind), pa.binary())], names=["vec_id", "packed"])

    known = scratch.store(vectors.mapInArrow(pack, "vec_id long, packed binary"))
    distinct = scratch.store(
        known.where("packed IS NOT NULL AND vec_id IS NOT NULL").groupBy("packed")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    )
    blocks = max(1, -(-distinct.count() // block_rows))
    block = F.pmod(F.xxhash64("packed"), F.lit(blocks)).cast("int")
    placed = distinct.withColumn("size", F.length("packed")).withColumn("block", block)
    # Once for every pair of blocks it belongs to.
    meeting = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "rep", "weight", "packed", "size", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block"
    )

    def compare(key, table):
        _, i, j = (k.as_py() for k in key)
        side = table.column("block").to_numpy()
        x = Block(table.filter(pa.array(side == i)), kind) if (side == i).any() else None
        y = Block(table.filter(pa.array(side == j)), kind) if i != j and (side == j).any() else None
        none = np.zeros(0, dtype=np.int64)
        if x is None or (i != j and y is None):
            ids, a, b, links = none, none, none, none
        else:
            links_x, links_y, forest = linked(x, y, threshold)
            ids, links = np.concatenate([x.ids, y.ids if y else none]), np.concatenate([links_x, links_y])
            a, b = (np.concatenate([ids[e[k]] for e in forest.edges]) if forest.edges else none for k in (0, 1))
            ids, links = ids[links > 0], links[links > 0]
        return pa.table({
            "a": pa.array(np.concatenate([ids, a]), pa.int64()),
            "b": pa.concat_arrays([pa.nulls(len(ids), pa.int64()), pa.array(b, pa.int64())]),
            "links": pa.concat_arrays([pa.array(links.astype(np.int64)), pa.nulls(len(a), pa.int64())]),
        })

    met = scratch.store(meeting.groupBy("size", "i", "j").applyInArrow(compare, "a long, b long, links long"))
    groups = components(met.where("b IS NOT NULL").select("a", "b"), scratch).toDF("rep", "component")
    counts = met.where("links IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    named = (
        distinct.join(counts, "rep", "left").join(groups, "rep", "left")
        .select("packed", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    member = F.col("vec_id").isNotNull()
    return known.join(named, "packed", "left").select(
        "vec_id",
        F.when(member, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        F.when(member, F.coalesce("component", "vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
