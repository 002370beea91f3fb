"""Near-duplicate documents by SuperMinHash.

Documents are sets of word shingles. Equal sets are one class from the start. Each class gets a SuperMinHash
signature; classes that agree in a whole band of it are candidates, whose sets are then compared in full.
Connected components of the links that hold give the groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B
from voltmark.llm.components import Forest, components
from voltmark.llm.scratch import Scratch

#: Bands of the signature and values in a band. A pair at similarity 0.8 agrees in no band with a chance of 3e-7.
BANDS, ROWS = 50, 6
#: Documents in a block of a cluster; a task holds two blocks.
BLOCK_DOCS = 512
_WORD, _SHINGLE, _BAND = B.Spans(11), B.Spans(13), B.Spans(17)
#: Up to this step, the permutation of an element is followed back through its swaps; from then on it is kept as a row.
_CHAIN = 12


def shingle_sets(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and how many each text has."""
    data, offsets = B.texts(batch.column("text"))
    found, counts = [], []
    for i, j in B.pieces(offsets):
        piece, starts_of = B.LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        starts, ends, text = B.words(piece, starts_of, B.NOT_SPACE)
        hashes = _WORD.of_bytes(piece, starts, ends)
        at = B.windows(text, size)
        ends_at = at + size
        n = np.bincount(text, minlength=j - i)
        short = np.flatnonzero((n > 0) & (n < size))
        first = np.searchsorted(text, short)
        at, ends_at = np.concatenate([at, first]), np.concatenate([ends_at, first + n[short]])
        of = text[at]
        shingles = _SHINGLE.of_values(hashes, at, ends_at)
        order = np.lexsort((shingles, of))
        shingles, of = shingles[order], of[order]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1])
        found.append(shingles[new])
        counts.append(np.bincount(of[new], minlength=j - i))
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(found) if found else none.view(np.uint64), np.concatenate(counts) if counts else none


def super_minhash(elements: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signatures of many sets at once: ``len(counts)`` rows of ``size`` values in [0, size].

    Each element has a random permutation of the slots and, at step k, a random number r in [0, 1): it
    offers ``r + k`` to the k-th slot of its permutation, and a slot keeps the least offer. Steps are taken by
    all elements together; once all slots of a set hold values below ``k + 1`` no later step can lower
    any, and its elements stop. The result is the same as with one element after another.
    """
    values = np.full(len(counts) * size, float(size), dtype=np.float64)
    owner = np.repeat(np.arange(len(counts)), counts)
    seeds = B.mixed(elements)
    picks: list[np.ndarray] = []  # for each step so far, the place that each living element swapped with
    rows = None  # permutations of the living elements
    open_sets = counts > 0
    for k in range(size):
        if not len(seeds):
            break
        random = B.mixed(seeds + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        offer = k + (random >> np.uint64(32)).astype(np.float64) / 2**32
        pick = k + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(size - k) >> np.uint64(32)).astype(np.int64)
        if k < _CHAIN:
            slot = pick
            for step in range(k - 1, -1, -1):
                slot = np.where(picks[step] == slot, step, slot)
            picks.append(pick)
        else:
            if rows is None:
                rows = np.tile(np.arange(size, dtype=np.uint16), (len(seeds), 1))
                for step, swapped in enumerate(picks):
                    _swap(rows, step, swapped)
                picks = []
            slot = rows[np.arange(len(rows)), pick].astype(np.int64)
            _swap(rows, k, pick)
        np.minimum.at(values, owner * size + slot, offer)
        # A set is done when its largest value is below k + 1; an empty slot holds ``size``.
        living = np.flatnonzero(open_sets)
        done = living[values.reshape(-1, size)[living].max(axis=1) < k + 1]
        if len(done):
            open_sets[done] = False
            stay = open_sets[owner]
            owner, seeds = owner[stay], seeds[stay]
            picks = [p[stay] for p in picks]
            rows = rows[stay] if rows is not None else None
    return values.reshape(-1, size)


def _swap(rows: np.ndarray, step: int, place: np.ndarray) -> None:
    each = np.arange(len(rows))
    held = rows[each, place]
    rows[each, place] = rows[:, step]
    rows[:, step] = held


def sketch(batch: pa.RecordBatch, shingle: int) -> pa.RecordBatch:
    """Set size, a 128-bit name of the set, and a hash of each band of the signature."""
    elements, counts = shingle_sets(batch, shingle)
    ends = np.concatenate([[0], np.cumsum(counts)])
    names = []
    for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B.mixed(elements ^ np.uint64(salt)))])
        names.append(B.mixed(sums[ends[1:]] - sums[ends[:-1]]))
    bands = np.zeros((len(counts), BANDS), dtype=np.uint64)
    band = B.random_table(19, BANDS)
    for i, j in B.pieces(ends, 100_000):
        signature = super_minhash(elements[ends[i] : ends[j]], counts[i:j], BANDS * ROWS).view(np.uint64).ravel()
        at = np.arange(0, len(signature), ROWS)
        bands[i:j] = B.mixed(_BAND.of_values(B.mixed(signature), at, at + ROWS).reshape(-1, BANDS) ^ band)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(counts.astype(np.int64)),
            *[pa.array(B.signed(n)) for n in names],
            B.lists(pa.array(B.signed(bands[counts > 0].ravel())), np.where(counts > 0, BANDS, 0)),
        ],
        names=["doc_id", "n_shingles", "s1", "s2", "bands"],
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs (doc_id long, text string)``.

    Words are longest runs of anything but ASCII white space, A-Z lower-cased. A document is its set of
    distinct shingles of ``shingle`` words; one with fewer words is that one sequence, one without words or
    text is linked with nothing. Documents are linked from a Jaccard similarity of ``similarity`` on, and
    ``component_id`` is the smallest ``doc_id`` that links lead to, ``kept`` tells whether that is the document's own.

    Rows with one ``doc_id`` count as one document that has all their sets. A row without ``doc_id`` takes part in
    nothing and is kept. Other columns are ignored. Members of a band bucket are compared with its
    smallest and its largest, and then with the members that those comparisons have left in another component,
    block by block (``left_apart``). So no link between two components is lost, and no pairs are sent around.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    share = int(round(similarity * 100))

    def sketches(batches):
        for batch in batches:
            yield sketch(batch, shingle)

    known = scratch.store(
        docs.mapInArrow(sketches, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>")
    )
    # One row for each distinct set, named by its smallest document. Minima are combined before the shuffle.
    sets = known.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    sets = scratch.store(sets)
    placed = sets.select("rep", "n", F.explode("bands").alias("bucket"))
    ends = placed.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    members = scratch.store(placed.join(ends, "bucket"))
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    # A sort-merge join at any size, so that cost follows the input evenly.
    texts = docs.join(wanted.hint("merge"), "doc_id", "left_semi")
    full = scratch.store(texts.mapInArrow(full_sets(shingle), "doc_id long, set binary"))

    def pairs_of(to: str) -> DataFrame:
        return members.where(F.col("rep") != F.col(to)).select(
            F.least("rep", to).alias("a"), F.greatest("rep", to).alias("b")
        )

    links = scratch.store(confirmed(pairs_of("low").unionByName(pairs_of("high")).distinct(), full, share))
    groups = scratch.store(components(links, scratch))
    more = scratch.store(left_apart(members, groups, full, share, scratch))
    if not more.isEmpty():
        groups = scratch.store(components(links.unionByName(more), scratch))

    named = sets.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", F.coalesce("component", "rep").alias("component_id")
    )
    result = known.select("doc_id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def full_sets(shingle: int):
    """For ``mapInArrow``: the whole set of each document, six bytes of each shingle's hash."""

    def run(batches):
        for batch in batches:
            elements, counts = shingle_sets(batch, shingle)
            ends = np.concatenate([[0], np.cumsum(counts)])
            raw = elements.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            packed = [raw[6 * ends[k] : 6 * ends[k + 1]] for k in range(len(counts))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "set"])

    return run


def _integers(packed: pa.Scalar) -> np.ndarray:
    raw = np.frombuffer(packed.as_buffer(), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), dtype=np.uint8)
    wide[:, :6] = raw
    return wide.view(np.uint64).ravel()


def confirmed(pairs: DataFrame, full: DataFrame, share: int) -> DataFrame:
    """The pairs ``a, b`` of documents whose full sets are similar enough."""

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = _integers(x), _integers(y)
                union = len(np.union1d(x, y))
                keep.append(100 * (len(x) + len(y) - union) >= share * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    both = pairs.join(full.toDF("a", "set_a"), "a").join(full.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def left_apart(members: DataFrame, groups: DataFrame, full: DataFrame, share: int, scratch: Scratch) -> DataFrame:
    """Links ``a, b`` between members of one bucket that its two ends have left in different components.

    Documents of such buckets form clusters by the buckets they share. A cluster is cut into blocks of
    bounded size, every two blocks meet in one task, and what comes out is a forest of links. A document of
    which too few shingles are in any other of these documents can have no link and is left aside.
    """
    rest = (
        members.where("rep != low AND rep != high")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select("bucket", "rep", "n", "low", F.coalesce("component", "rep").alias("component"))
    )
    spread = rest.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    rest = scratch.store(rest.join(spread.where("c1 < c2").select("bucket"), "bucket"))
    docs = rest.select("rep", "n", "component").distinct()

    def exploded(batches):
        for batch in batches:
            sets = [_integers(x) for x in batch.column("set")]
            ids = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in sets])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(sets).view(np.int64))], names=["rep", "shingle"])

    own = scratch.store(full.join(docs.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").distinct())
    shingles = own.mapInArrow(exploded, "rep long, shingle long")
    shared = shingles.groupBy("shingle").count().where("count > 1").select("shingle")
    common = shingles.join(shared, "shingle").groupBy("rep").agg(F.count("*").alias("k"))
    docs = scratch.store(docs.join(common, "rep").where(F.col("k") * 100 >= F.col("n") * share).select("rep", "component"))

    clusters = components(rest.select(F.col("rep").alias("a"), F.col("low").alias("b")), scratch).toDF("rep", "cluster")
    placed = scratch.store(docs.join(clusters, "rep"))
    sizes = placed.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK_DOCS).cast("int").alias("blocks"))
    blocked = placed.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    meeting = blocked.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "rep", "component", "cluster", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")
    )

    def compare(key, table):
        _, i, j = (k.as_py() for k in key)
        block = table.column("block").to_numpy()
        x, y = np.flatnonzero(block == i), np.flatnonzero(block == j)
        reps, component = table.column("rep").to_numpy(), table.column("component").to_numpy()
        forest = Forest(len(reps))
        if len(x) and len(y) and component.min() < component.max():
            sets = [_integers(v) for v in table.column("set")]
            sizes = np.array([len(v) for v in sets])
            shared = intersections([sets[k] for k in x], [sets[k] for k in y])
            union = sizes[x][:, None] + sizes[y][None, :] - shared
            r, c = np.nonzero((100 * shared >= share * union) & (component[x][:, None] != component[y][None, :]))
            forest.add(x[r], y[c])
        a, b = (np.concatenate([reps[e[k]] for e in forest.edges]) if forest.edges else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    with_sets = meeting.join(own.toDF("rep", "set"), "rep")
    return with_sets.groupBy("cluster", "i", "j").applyInArrow(compare, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``left`` shares with each of ``right``: elements of many sets by matrix
    products, those of few by listing the pairs."""
    elements = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(v) for v in (*left, *right)])
    _, column, times = np.unique(elements, return_inverse=True, return_counts=True)
    result = np.zeros((len(left), len(right)))
    rare = (times > 1) & (times <= 8)
    keep = rare[column]
    order = np.argsort(column[keep], kind="stable")
    col, own = column[keep][order], owner[keep][order]
    starts = np.searchsorted(col, col)
    count = times[col]
    first = np.repeat(np.arange(len(col)), count)
    second = np.repeat(starts, count) + np.arange(len(first)) - np.repeat(np.cumsum(count) - count, count)
    a, b = own[first], own[second]
    cross = (a < len(left)) & (b >= len(left))
    np.add.at(result, (a[cross], b[cross] - len(left)), 1)
    heavy = np.flatnonzero(times > 8)
    place = np.full(len(times), -1)
    place[heavy] = np.arange(len(heavy))
    for start in range(0, len(heavy), 4096):
        some = (place[column] >= start) & (place[column] < start + 4096)
        matrix = np.zeros((len(left) + len(right), min(4096, len(heavy) - start)), dtype=np.float32)
        matrix[owner[some], place[column[some]] - start] = 1
        result += matrix[: len(left)] @ matrix[len(left) :].T
    return result.astype(np.int64)
