"""How the sources of a language differ from each other and from the language as a whole, by their terms.

The work is done on cells, not on terms: all terms with the same count in a group and the same count in its
language have the same divergence, so it is computed once per cell; cells are ranked by how many terms lie above
them, cells of equal value become one, and only the cells that reach the ranks asked for are expanded to terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltmark.llm.scratch import Scratch, small_batches

#: Bytes of terms, which are runs of ASCII letters and characters outside ASCII; everything else ends a term.
_AS_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Counts that a task holds before it sends them on, and bytes of a text whose words it holds at once.
HELD_TERMS, PIECE_BYTES = 1 << 19, 1 << 19
#: Terms and sources that are compared in one task, about: two blocks of sources over one bucket of terms.
TILE_TERMS, TILE_SOURCES = 1 << 13, 64


def divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value long, rank int`` for ``docs (text, lang, source)``.

    A language keeps the terms that at least ``min_docs`` of its documents hold. A group, which is a source of a
    language or the language itself, gives each kept term the share ``p = 1 + floor(10^9 (count + 1) / (N + V))``, with
    ``N`` the group's occurrences of kept terms and ``V`` the number of kept terms. The divergence of a term is
    ``floor((p - q)^2 / q)``.

    * part ``pair``: ``item`` is another source of the language, ``q`` its share, ``value`` the sum over all kept terms.
    * part ``term``: ``item`` is a kept term that the source holds with ``p > q``, ``q`` the share in the language;
      ranks to ``top``.

    Ranks count from 1 in each source and part, by falling value and then by the bytes of the item. Integers only, so
    results are exact and the same on every run.

    Null text, language or source is the empty string. A source without terms is compared like any other; a language
    without kept terms has pairs of value 0 and no terms. Every row is a document, repeated ones too. Other columns
    are not read, whatever their names. An empty table gives an empty result.

    The number of pairs is the square of the sources of a language, as all are asked for; they are computed in tiles of
    two blocks of sources and a bucket of terms, and a task returns one number for each pair. Otherwise terms are
    counted before they are shuffled, and a hot source or term is one row for each task.
    """
    scratch = Scratch(docs.sparkSession, "source-audit")
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = scratch.store(_counts(plain))
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("whole_n"), F.sum("docs").alias("docs"))
    whole = scratch.store(whole.where(F.col("docs") >= min_docs).drop("docs"))
    languages = whole.groupBy("lang").agg(F.sum("whole_n").alias("whole_total"), F.count(F.lit(1)).alias("vocabulary"))
    kept = scratch.store(counts.select("lang", "source", "term", "n").join(whole, ["lang", "term"]))
    sources = scratch.store(_sources(plain, kept, languages))
    scratch.drop(counts, whole)
    parts = _pairs(kept, sources).unionByName(_terms(kept, sources, top))
    return parts.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def _counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each source, and documents that hold it."""
    small_batches(docs.sparkSession)
    part = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return part.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of a partition, sent on whenever so many are held. Texts are worked on as bytes: all bytes
    of characters outside ASCII belong to terms, and only ASCII letters change their case."""
    held: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for row, group in enumerate(groups):
            n, documents = held.setdefault(group, (Counter(), Counter()))
            distinct: set[bytes] = set()
            for words in _words(texts[row].as_py()):
                n.update(words)
                distinct.update(words)
            documents.update(distinct)
        if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
            yield from _sent(held)
            held = {}
    yield from _sent(held)


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of some hundred thousand bytes at once."""
    text, start = text.translate(_AS_TERM), 0
    while start < len(text):
        end = text.find(b" ", start + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _sent(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, documents) in held.items():
        for terms in batched(n, 1 << 16):
            ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.StringArray.from_buffers(len(terms), pa.py_buffer(ends), pa.py_buffer(b"".join(terms))),
                    pa.array([n[t] for t in terms], pa.int64()),
                    pa.array([documents[t] for t in terms], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )


def _sources(docs: DataFrame, kept: DataFrame, languages: DataFrame) -> DataFrame:
    """One row for each source of a language, also those without terms, with what shares are computed from."""
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    rows = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    rows = rows.na.fill(0, ["total", "whole_total", "vocabulary"])
    return rows.select("*", F.floor(number / TILE_SOURCES).cast("int").alias("block"))


def share(n: Column, total: Column, vocabulary: Column) -> Column:
    """``1 + floor(10^9 (n + 1) / (total + vocabulary))``, exact: the product doesn't fit a long."""
    scaled = (n + 1).cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.call_function("div", scaled, (total + vocabulary).cast("decimal(20,0)")) + 1


def _value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _ranked(rows: DataFrame) -> DataFrame:
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(by))


def _terms(kept: DataFrame, sources: DataFrame, top: int) -> DataFrame:
    group = ["lang", "source"]
    cells = kept.groupBy(*group, "n", "whole_n").agg(F.count(F.lit(1)).alias("many")).join(sources, group)
    cells = cells.select(
        *group, "n", "whole_n", "many",
        share(F.col("n"), F.col("total"), F.col("vocabulary")).alias("p"),
        share(F.col("whole_n"), F.col("whole_total"), F.col("vocabulary")).alias("q"),
    )
    cells = cells.where("p > q").select(*group, "n", "whole_n", "many", _value("p", "q").alias("value"))
    values = cells.groupBy(*group, "value").agg(F.sum("many").alias("many"))
    # Each value has a term at least, so no more than ``top`` values of a group reach the ranks.
    falling = Window.partitionBy(*group).orderBy(F.desc("value"))
    values = values.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)
    above = F.sum("many").over(falling.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("many")
    reached = values.withColumn("above", above).where(F.col("above") < top).select(*group, "value", "above")
    reached = cells.join(reached, [*group, "value"]).select(*group, "n", "whole_n", "value", "above")
    terms = kept.join(reached, [*group, "n", "whole_n"]).select(*group, F.col("term").alias("item"), "value", "above")
    place = F.row_number().over(Window.partitionBy(*group, "value").orderBy("item"))
    terms = terms.withColumn("place", place).where(F.col("place") <= top).withColumn("rank", F.col("above") + F.col("place"))
    return terms.where(F.col("rank") <= top).select(*group, F.lit("term").alias("part"), "item", "value", "rank")


def _pairs(kept: DataFrame, sources: DataFrame) -> DataFrame:
    blocks = sources.groupBy("lang").agg((F.max("block") + 1).alias("blocks"))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("vocabulary") / TILE_TERMS)).cast("int")
    sources = sources.join(blocks, "lang").withColumn("buckets", buckets)
    p = share(F.col("n"), F.col("total"), F.col("vocabulary"))
    terms = kept.join(sources, ["lang", "source"]).select(
        "lang", "source", "block", "blocks", "term", F.expr("cast(pmod(xxhash64(term), buckets) as int)").alias("bucket"),
        p.alias("p"), "vocabulary",
    )
    # Every tile also has a row for each of its sources, with the share of a term that the source doesn't hold.
    none = F.when(F.col("vocabulary") > 0, share(F.lit(0), F.col("total"), F.col("vocabulary"))).otherwise(1)
    empty = sources.select(
        "lang", "source", "block", "blocks", F.lit(None).cast("string").alias("term"),
        F.explode(F.expr("sequence(0, buckets - 1)")).alias("bucket"), none.alias("p"), "vocabulary",
    )
    rows = terms.unionByName(empty).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks")
    sums = rows.groupBy("lang", "bucket", "i", "j").applyInArrow(_tile, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")


def _tile(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums of the divergence of each source of a block from each of the other, over the terms of a bucket.

    Terms of the bucket that neither block holds add the same number each, as all others do: it is
    taken off here for those that are held, and the tile of the first bucket adds it for the whole vocabulary.
    """
    lang, bucket, i, j = (k.as_py() for k in key)
    term = rows.column("term").combine_chunks()
    own = term.is_null().to_numpy(zero_copy_only=False)
    names = rows.column("source").combine_chunks()
    shares = rows.column("p").to_numpy().astype(np.int64)
    blocks = rows.column("block").to_numpy()
    listed = names.filter(pa.array(own))
    block = blocks[own]
    coded = term.filter(pa.array(~own)).dictionary_encode()
    default = shares[own]
    table = np.repeat(default[:, None], len(coded.dictionary), axis=1)
    at = pc.index_in(names.filter(pa.array(~own)), listed).to_numpy()
    table[at, coded.indices.to_numpy()] = shares[~own]
    vocabulary = rows.column("vocabulary")[0].as_py() if bucket == 0 else 0
    out: tuple[list, list, list] = ([], [], [])
    for a in range(len(default)):
        others = np.flatnonzero((block == (j if block[a] == i else i)) & (np.arange(len(block)) != a))
        q = table[others]
        apart = table[a] - q
        sums = (apart * apart // q).sum(axis=1)
        alike = (default[a] - default[others]) ** 2 // default[others]
        out[0].append(np.full(len(others), a))
        out[1].append(others)
        out[2].append(sums + (vocabulary - table.shape[1]) * alike)
    a, b, value = (np.concatenate(x) for x in out)
    return pa.table(
        {"lang": pa.array([lang] * len(a), pa.string()), "source": listed.take(pa.array(a)), "item": listed.take(pa.array(b)), "value": pa.array(value, pa.int64())}
    )
