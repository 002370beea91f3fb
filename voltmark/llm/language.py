"""Language identification: words first, character n-grams for words never seen.

A known word speaks for each language with its log frequency there. An unseen word is taken apart into its
longest character n-grams; if none of them is known, into shorter ones, and so on. A text sums what its words say.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltmark.llm import batches as B

#: About how many documents of each language the model learns from (those whose id has the smallest hashes; all where there are fewer), and
#: words of each language that it keeps at most.
SAMPLE_ROWS, MODEL_WORDS = 6_000, 100_000
LONGEST = 5
UNDETERMINED = "und"
#: Words a task remembers the evidence of, and bytes of it; beyond either it starts anew.
REMEMBERED, REMEMBERED_BYTES = 500_000, 32 << 20
#: An n-gram counts if it stands so often in the words that are kept, in all languages together.
GRAM_TIMES = 3
LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class LanguageModel:
    """``words`` and ``grams[n]`` lead to rows of evidence: how much more often than never, as a logarithm, each of ``languages``
    has it. Most words are of few languages, so a row holds those alone: ``of[k]`` and ``more[k]`` for k from ``first[row]`` on."""

    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: list[dict[str, int]]
    first: np.ndarray
    of: np.ndarray
    more: np.ndarray
    table: np.ndarray | None = None  # the same as a full table, where that is small enough to be looked up in

    def fill(self, most_bytes: int) -> None:
        rows, columns = len(self.first) - 1, len(self.languages)
        if self.table is None and rows * columns * 8 <= most_bytes:
            self.table = np.zeros((rows, columns))
            self.table[np.repeat(np.arange(rows), np.diff(self.first)), self.of] = self.more

    def of_rows(self, rows: list[int]) -> np.ndarray:
        """The mean of some rows, over all languages."""
        if self.table is not None:
            return self.table[rows[0]] if len(rows) == 1 else self.table[rows].mean(axis=0)
        total = np.zeros(len(self.languages))
        for row in rows:
            a, b = self.first[row], self.first[row + 1]
            total[self.of[a:b]] += self.more[a:b]
        return total / len(rows)

    def of_word(self, word: str) -> np.ndarray:
        row = self.words.get(word)
        if row is not None:
            return self.of_rows([row])
        padded = f"^{word}$"
        for n in range(min(LONGEST, len(padded)), 0, -1):
            table = self.grams[n]
            known = [table[g] for g in (padded[k : k + n] for k in range(len(padded) - n + 1)) if g in table]
            if known:
                return self.of_rows(known)
        return np.zeros(len(self.languages))


class Identifier:
    """Predictions for many texts, with the words met so far remembered."""

    def __init__(self, model: LanguageModel):
        self.model = model
        model.fill(2 * REMEMBERED_BYTES)
        self.rows: dict[str, int] = {}
        self.most = max(1000, min(REMEMBERED, REMEMBERED_BYTES // (8 * max(1, len(model.languages)))))
        self.evidence = np.zeros((self.most, len(model.languages)))

    def identify(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall((text or "").lower())
        # Superscripts, fractions and numerals are word characters, but no letters.
        if not self.model.languages or not any(w.isalpha() or any(map(str.isalpha, w)) for w in words):
            return UNDETERMINED, 0.0
        total = self.model.prior.copy()
        for start in range(0, len(words), self.most):
            total += self.evidence[self._rows(words[start : start + self.most])].sum(axis=0)
        weights = (total - total.max()) / np.sqrt(len(words))
        weights = np.exp(weights)
        best = int(np.argmax(total))
        return self.model.languages[best], float(weights[best] / weights.sum())

    def _rows(self, words: list[str]) -> list[int]:
        new = set(words).difference(self.rows)
        if len(self.rows) + len(new) > self.most:
            self.rows, new = {}, set(words)
        for word in new:
            row = self.rows[word] = len(self.rows)
            self.evidence[row] = self.model.of_word(word)
        return list(map(self.rows.__getitem__, words))


def held_out(doc_id) -> F.Column:
    """A third of the documents, which nothing is learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 3 == 1


def trained(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, model_words: int = MODEL_WORDS) -> LanguageModel:
    """Log frequencies from ``docs (doc_id, text, lang)``: documents that aren't held out and have a language and text.

    Every language of those has a part: all its documents where they are no more than ``sample_rows``, else about that many.
    Words are counted on the executors over their whole texts; the ``model_words`` most frequent words of each language
    come to the driver. The prior is the share of a language in all the documents.
    """
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out("doc_id"))
    documents = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).toArrow().to_pylist()}
    shares = docs.sparkSession.createDataFrame([(lang, min(1.0, sample_rows / n)) for lang, n in documents.items()], "lang string, share double")
    # Languages are bounded by a threshold on the hash, not by a rank, so that none has to be sorted in one task.
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    chosen = usable.join(F.broadcast(shares), "lang").where(place < F.col("share")).select("lang", "text")

    def words(batches):
        for batch in batches:
            counts: dict[tuple[str, str], int] = defaultdict(int)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word in LETTERS.findall((text or "").lower()):
                    counts[lang, word] += 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(counts.values(), pa.int64())],
                names=["lang", "word", "n"],
            )

    counted = chosen.mapInArrow(words, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    kept = counted.withColumn("rank", rank).where(F.col("rank") <= model_words).select("word", "lang", "n").orderBy(F.desc("n"), "word", "lang")
    frequent = kept.toArrow()
    return from_counts(list(zip(*(frequent.column(c).to_pylist() for c in ("word", "lang", "n")), strict=True)), documents)


def from_counts(counts: list[tuple[str, str, int]], documents: dict[str, int] | None = None) -> LanguageModel:
    """A model from how often each word stands in each language; of n-grams those seen at least ``GRAM_TIMES`` times count.
    Languages are weighed by their ``documents``, or else by their words."""
    languages = sorted({lang for _, lang, _ in counts})
    place = {lang: k for k, lang in enumerate(languages)}
    tables: list[dict[str, dict[int, int]]] = [defaultdict(dict) for _ in range(LONGEST + 1)]
    for word, lang, n in counts:
        k = place[lang]
        row = tables[0][word]
        row[k] = row.get(k, 0) + n
        padded = f"^{word}$"
        for size in range(1, min(LONGEST, len(padded)) + 1):
            table = tables[size]
            for start in range(len(padded) - size + 1):
                row = table[padded[start : start + size]]
                row[k] = row.get(k, 0) + n
    lookups: list[dict[str, int]] = []
    sizes, of, more = [np.zeros(1, np.int64)], [], []
    base = 0
    for size, table in enumerate(tables):
        held = {x: row for x, row in table.items() if size == 0 or sum(row.values()) >= GRAM_TIMES}
        table.clear()
        widths = np.fromiter(map(len, held.values()), np.int64, len(held))
        langs = np.fromiter((k for row in held.values() for k in row), np.int32, widths.sum())
        times = np.fromiter((n for row in held.values() for n in row.values()), np.float64, widths.sum())
        seen = np.maximum(np.bincount(langs, times, len(languages)), 1.0) if len(languages) else np.ones(1)
        # What a language never has counts alike for all: half of one occurrence in the largest.
        never = 0.5 / seen.max()
        of.append(langs)
        more.append(np.log(times / seen[langs] + never) - np.log(never) if len(langs) else times)
        sizes.append(widths)
        lookups.append({x: base + k for k, x in enumerate(held)})
        base += len(held)
    totals = np.zeros(len(languages))
    for _, lang, n in counts if documents is None else [(None, lang, n) for lang, n in documents.items() if lang in place]:
        totals[place[lang]] += n
    prior = np.log(totals / totals.sum()) if len(languages) else totals
    return LanguageModel(languages, prior, lookups[0], lookups, np.cumsum(np.concatenate(sizes)), np.concatenate(of), np.concatenate(more))


def identified(docs: DataFrame, model: LanguageModel, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    ``und`` with score 0 for null texts and texts without letters. A text whose words and letters are all unknown gets the
    language that the model has most of. Columns of those names are replaced, all others stay, ``text`` only with ``keep_text``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    holder: list[Identifier] = []

    def compute(batch):
        if not holder:
            holder.append(Identifier(sent.value))
        found = [holder[0].identify(t.as_py()) for t in batch.column("text")]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return B.with_arrow(docs, "lang_pred string, score double", compute, consumed=() if keep_text else ("text",))
