"""Quality classifier: a generalised additive model with pairwise interactions.

Each text gives a few dozen numbers, each number falls into a bin, and the model is one lookup table for each
number and one for each chosen pair of numbers. Tables are learned by cyclic boosting: every round
gives each table one shallow tree with a small step. Scoring adds table entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltmark.llm import batches as B

_WORD, _PAIR, _LINE = B.Spans(31), B.Spans(37), B.Spans(41)
#: Labelled rows the model is fitted on at most: those whose id has the smallest hashes.
SAMPLE_ROWS = 20_000
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".,;:?'\"()-")] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[[b for b in range(0x21, 0x7F) if not (_LETTER[b] or _DIGIT[b] or _STOP[b])]] = True

FEATURES = (
    "log_chars", "log_words", "word_length", "word_length_spread", "letters", "capitals", "digits", "stops", "odd",
    "outside_ascii", "spaces", "lines_per_word", "line_length", "new_words", "new_pairs", "new_lines", "top_word",
    "odd_ends", "short_words", "long_words", "stop_ends", "capital_words",
)


def features(column) -> np.ndarray:
    """A row of numbers for each text; an empty or null text has all zeros."""
    data, offsets = B.texts(column)
    parts = [_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in B.pieces(offsets)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def _distinct(values: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and how often its most frequent one stands."""
    order = np.lexsort((values, of))
    values, of = values[order], of[order]
    new = np.ones(len(of), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, of[first], np.diff(np.append(first, len(of))))
    return np.bincount(of[first], minlength=n), top


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    def per_text(flags):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    size = np.maximum(np.diff(offsets), 1).astype(float)
    chars = per_text((data & 0xC0) != 0x80)
    starts, ends, of = B.words(data, offsets, B.NOT_SPACE)
    words = np.bincount(of, minlength=n).astype(float)
    per_word = np.maximum(words, 1)
    lengths = (ends - starts).astype(float)
    mean = np.bincount(of, lengths, minlength=n) / per_word
    spread = np.sqrt(np.maximum(np.bincount(of, lengths**2, minlength=n) / per_word - mean**2, 0))
    hashes = _WORD.of_bytes(B.LOWER[data], starts, ends)
    new_words, top = _distinct(hashes, of, n)
    at = B.windows(of, 2)
    new_pairs, _ = _distinct(_PAIR.of_values(hashes, at, at + 2), of[at], n)
    pairs = np.bincount(of[at], minlength=n)
    is_line = np.ones(256, dtype=bool)
    is_line[10] = False
    line_starts, line_ends, line_of = B.words(data, offsets, is_line)
    lines = np.bincount(line_of, minlength=n).astype(float)
    new_lines, _ = _distinct(_LINE.of_bytes(data, line_starts, line_ends), line_of, n)
    letters = per_text(_LETTER[data])

    def words_with(flags):
        return np.bincount(of[flags], minlength=n) / per_word

    last, first = data[ends - 1], data[starts]
    return np.column_stack([
        np.log1p(chars), np.log1p(words), mean, spread, letters / size, per_text(_UPPER[data]) / np.maximum(letters, 1),
        per_text(_DIGIT[data]) / size, per_text(_STOP[data]) / size, per_text(_ODD[data]) / size, per_text(data >= 128) / size,
        per_text(~B.NOT_SPACE[data]) / size, lines / per_word, np.log1p(chars / np.maximum(lines, 1)), new_words / per_word,
        new_pairs / np.maximum(pairs, 1), new_lines / np.maximum(lines, 1), top / per_word, words_with(_ODD[last]),
        words_with(lengths <= 3), words_with(lengths >= 12), words_with(_STOP[last]), words_with(_UPPER[first]),
    ])


@dataclass
class Additive:
    """``edges[f]``: ascending bin borders of number ``f``; ``tables[f]``: its contribution by bin.
    ``pairs``: for two numbers, coarser borders of both and a table."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        for a, b, ea, eb, table in self.pairs:
            total += table[np.searchsorted(ea, x[:, a], side="right"), np.searchsorted(eb, x[:, b], side="right")]
        return 1 / (1 + np.exp(-total))


def _borders(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A tree over ordered bins: the split that lowers the loss most, again and again. The value of each bin."""
    cuts = [0, len(grad)]
    g, h = np.append(0, np.cumsum(grad)), np.append(0, np.cumsum(hess))

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)

    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                m = np.arange(a + 1, b)
                better = gain(a, m) + gain(m, b) - gain(a, b)
                k = int(np.argmax(better))
                best = max(best, (float(better[k]), int(m[k])), key=lambda t: t[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    values = np.empty(len(grad))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        values[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return values


def _quarters(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best tree that cuts both numbers of a pair once: its gain and the value of each cell."""
    def corners(x):
        s = np.pad(np.cumsum(np.cumsum(x, 0), 1), ((1, 0), (1, 0)))[1:-1, 1:-1]
        rows, columns = np.cumsum(x.sum(1))[:-1, None], np.cumsum(x.sum(0))[None, :-1]
        return np.stack([s, rows - s, columns - s, x.sum() - rows - columns + s])

    g, h = corners(grad), corners(hess)
    gain = (g**2 / (h + ridge)).sum(0)
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    v = g[:, i, j] / (h[:, i, j] + ridge)
    values = np.empty_like(grad)
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = v
    return float(gain[i, j] - grad.sum() ** 2 / (hess.sum() + ridge)), values


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, step: float = 0.08, bins: int = 32, pairs: int = 8, leaves: int = 3, ridge: float = 5.0) -> Additive:
    """Fits the tables to 0/1 labels. A sixth of the rows is held back; the tables are those of the round
    at which the loss on them was least. With one label only, every score is that label's share (smoothed)."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Additive(base=float(np.log(share / (1 - share))))
    if not 0 < y.sum() < len(y):
        return model
    model.edges = [_borders(x[:, f], bins) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    held = np.arange(len(y)) % 6 == 5
    train = ~held
    codes = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    total = np.full(len(y), model.base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return np.where(train, y - p, 0), np.where(train, p * (1 - p), 0)

    def loss():
        some = held if 0 < y[held].sum() < held.sum() else train
        return float(np.mean(np.logaddexp(0, np.where(y[some] > 0, -total[some], total[some]))))

    def boost(learn):
        best, kept, since = loss(), None, 0
        for _ in range(rounds):
            learn()
            now = loss()
            if now < best - 1e-6:
                best, kept, since = now, ([t.copy() for t in model.tables], [p[4].copy() for p in model.pairs], total.copy()), 0
            elif (since := since + 1) >= 20:
                break
        return kept

    def singles():
        for f, code in enumerate(codes):
            grad, hess = slopes()
            n = len(model.tables[f])
            change = step * _tree(np.bincount(code, grad, n), np.bincount(code, hess, n), leaves, ridge)
            model.tables[f] += change
            total[:] += change[code]

    def restore(kept):
        tables, grids, at = kept or ([np.zeros_like(t) for t in model.tables], [np.zeros_like(p[4]) for p in model.pairs], None)
        model.tables = tables
        model.pairs = [(*p[:4], g) for p, g in zip(model.pairs, grids, strict=True)]
        total[:] = at if at is not None else model.base

    restore(boost(singles))
    # Pairs that explain most of what single numbers leave.
    coarse = [_borders(x[:, f], 8) for f in range(x.shape[1])]
    places = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    grad, hess = slopes()

    def grid(a, b, weights):
        return np.bincount(places[a] * (len(coarse[b]) + 1) + places[b], weights, (len(coarse[a]) + 1) * (len(coarse[b]) + 1)).reshape(len(coarse[a]) + 1, -1)

    ranked = sorted(
        ((_quarters(grid(a, b, grad), grid(a, b, hess), ridge)[0], a, b) for a, b in combinations(range(x.shape[1]), 2) if len(coarse[a]) and len(coarse[b])),
        reverse=True,
    )
    model.pairs = [(a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for _, a, b in ranked[:pairs]]
    single_tables, single_total = [t.copy() for t in model.tables], total.copy()

    def doubles():
        for a, b, _, _, table in model.pairs:
            grad, hess = slopes()
            change = step * _quarters(grid(a, b, grad), grid(a, b, hess), ridge)[1]
            table += change
            total[:] += change[places[a], places[b]]

    kept = boost(doubles) if model.pairs else None
    restore(kept or (single_tables, [np.zeros_like(p[4]) for p in model.pairs], single_total))
    return model


def held_out(doc_id) -> F.Column:
    """A fifth of the documents, which nothing is learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def trained(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """The model for ``labels (doc_id, quality)``, from texts of labelled documents that aren't held out.

    Labels other than 0 and 1 are ignored; of several labels of a document the lowest counts. At most
    ``sample_rows`` labelled documents are used, those with the smallest hashes of their ids; only their ids
    go to the executors and only their numbers come to the driver.
    """
    chosen = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out("doc_id"))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    fields = "x array<double>"
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    measured = B.with_arrow(texts, fields, _as_lists, consumed=("text",)).orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample_rows).toArrow()
    x = np.array(measured.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, np.array(measured.column("quality").to_pylist(), dtype=float))


def _as_lists(batch: pa.RecordBatch) -> list[pa.Array]:
    x = features(batch.column("text"))
    return [B.lists(pa.array(x.ravel()), np.full(len(x), x.shape[1]))]


def scored(docs: DataFrame, model: Additive, threshold: float = 0.3, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts are scored like a text without words. All columns of ``docs`` stay, ``text`` only
    with ``keep_text``; those with one of the two names are replaced.
    """

    def compute(batch):
        scores = model.scores(features(batch.column("text")))
        return [pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]

    return B.with_arrow(docs, "score double, predicted int", compute, consumed=() if keep_text else ("text",))
