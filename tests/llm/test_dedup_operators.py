"""Line, near-duplicate, substring and embedding deduplication against brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from llm_fixtures import corpus, docs_of  # noqa: F401
from voltmark.llm import batches as B
from voltmark.llm import embedding_dedup, line_dedup, near_dedup, substring_dedup
from voltmark.llm.components import Forest, components
from voltmark.llm.scratch import Scratch

SPACE = " \t\n\x0b\x0c\r"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


# -- lines ------------------------------------------------------------------------


def plain_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    result = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if i is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        result[i] = (len(lines), len(lines) - len(keep), sha("\n".join(keep)))
    return result


def test_lines_against_brute_force(docs_of, corpus):
    rows = [*corpus, (5, None), (None, "no id here but some words")]
    got = line_dedup.deduplicated(docs_of(corpus)).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == plain_lines(rows)
    assert sum(r.n_dropped for r in got) >= 8
    assert {r.version for r in got if r.doc_id} == {"v", None} and {r.kept for r in got if r.doc_id} == {"k", None}


def test_a_line_twice_in_one_document_counts_once(docs_of):
    line = "x" * 40
    rows = [(i, f"{line}\nown {i}\n{line}") for i in range(1, 5)]
    kept = line_dedup.deduplicated(docs_of(rows, False), min_docs=5)
    assert kept.where("n_dropped > 0").isEmpty()
    rows.append((9, " " + line.upper() + "\t"))
    got = {r.doc_id: (r.n_dropped, r.text) for r in line_dedup.deduplicated(docs_of(rows, False), min_docs=5).collect()}
    assert got == {**{i: (2, f"own {i}") for i in range(1, 5)}, 9: (0, " " + line.upper() + "\t")}


def test_lines_that_run_over_partitions_are_decided_alike():
    rng = random.Random(2)
    rows = sorted(((h, 0, d, 0, n) for h in range(6) for d in rng.sample(range(40), rng.randrange(1, 12)) for n in range(rng.randrange(1, 3))), key=lambda r: (r[0], r[1], -r[2], r[4]))
    whole = {(r[2], r[4], r[0]) for r in rows if len({x[2] for x in rows if x[0] == r[0]}) >= 5 and r[2] < max(x[2] for x in rows if x[0] == r[0])}
    by_range = sorted(rows, key=lambda r: (r[0], r[2]))
    for size in (3, 7, 20):
        parts = [by_range[k : k + size] for k in range(0, len(by_range), size)]
        # A document's lines of one hash stay together, as the range of (hash, document) has it.
        for a, b in zip(parts, parts[1:], strict=False):
            while a and b and (a[-1][0], a[-1][2]) == (b[0][0], b[0][2]):
                a.append(b.pop(0))
        dropped, counts, open_rows = set(), defaultdict(lambda: [0, -1]), []
        for part in parts:
            part.sort(key=lambda r: (r[0], -r[2], r[4]))
            for h, _, doc, _, line, n in line_dedup.repeats(part, 5):
                if n is not None:
                    counts[h] = [counts[h][0] + n, max(counts[h][1], doc)]
                elif h is None:
                    dropped.add((doc, line))
                else:
                    open_rows.append((h, doc, line))
        dropped |= {(d, n) for h, d, n in open_rows if counts[h][0] >= 5 and d < counts[h][1]}
        assert dropped == {(d, n) for d, n, _ in whole}


def test_bitmap_keeps_lines_beyond_its_end():
    keep = line_dedup.bitmap(np.array([1, 3]))
    assert line_dedup.split_kept("\n".join("abcdefghijkl"), keep) == (list("acefghijkl"), 12)


# -- near duplicates ----------------------------------------------------------------


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_against_brute_force(docs_of, corpus, size):
    sets = {i: shingles(t, size) for i, t in [*corpus, (5, None)]}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    expected = least_reachable(ids, links)
    got = near_dedup.near_duplicates(docs_of(corpus), shingle=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {
        i: (len(sets[i]), expected[i], expected[i] == i) for i in ids
    }
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert len(links) > 10


def test_near_duplicates_of_a_chain_and_a_large_group(docs_of):
    """Copies whose ends are not similar, and members that no end of a bucket is similar to."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(100)]
    rows = []
    for k in range(60):
        words = list(base)
        for _ in range(rng.randrange(0, 14)):
            words[rng.randrange(100)] = f"v{rng.randrange(20)}"
        rows.append((1000 - k, " ".join(words)))
    sets = {i: shingles(t, 2) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    expected = least_reachable(sets, links)
    got = near_dedup.near_duplicates(docs_of(rows, False), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_super_minhash_is_that_of_one_element_after_another():
    from voltmark.llm import batches as B

    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 2, 40, 0, 300)]
    size = 24
    got = near_dedup.super_minhash(np.concatenate(sets), np.array([len(s) for s in sets]), size)
    for row, elements in zip(got, sets, strict=True):
        values = [float(size)] * size
        for seed in B.mixed(elements):
            order = list(range(size))
            for k in range(size):
                r = B.mixed(np.array([seed]) + np.uint64((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64))[0]
                place = k + int((int(r) & 0xFFFFFFFF) * (size - k) >> 32)
                order[k], order[place] = order[place], order[k]
                values[order[k]] = min(values[order[k]], k + (int(r) >> 32) / 2**32)
        assert row.tolist() == values


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(3)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (400, 50, 50))
    x, y = np.concatenate([common, a]), np.concatenate([common, b])
    signature = near_dedup.super_minhash(np.concatenate([x, y]), np.array([450, 450]), 300)
    assert abs((signature[0] == signature[1]).mean() - 0.8) < 0.08


def test_intersections():
    rng = np.random.default_rng(0)
    left = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(15)]
    right = [np.unique(rng.integers(0, 5000, rng.integers(1, 50)).astype(np.uint64)) for _ in range(9)] + left[:4]
    expected = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert near_dedup.intersections(left, right).tolist() == expected


# -- substrings -----------------------------------------------------------------------


def plain_substrings(rows, window):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    result = {}
    for i, w in words.items():
        gone = {p for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        kept = [x for p, x in enumerate(w) if p not in gone]
        result[i] = (len(w), len(gone), sha(b" ".join(kept).decode()))
    return result


@pytest.mark.parametrize(("window", "common"), [(13, 1000), (13, 2), (4, 3), (2, 1000)])
def test_substrings_against_brute_force(docs_of, corpus, window, common, monkeypatch):
    monkeypatch.setattr(substring_dedup, "COMMON", common)
    original = substring_dedup.removals
    monkeypatch.setattr(substring_dedup, "removals", lambda docs, w: original(docs, w, shard_words=700, common=common))
    got = substring_dedup.deduplicated(docs_of(corpus), window=window).collect()
    expected = plain_substrings([*corpus, (5, None)], window)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got if r.doc_id is not None} == expected
    assert [r.n_removed for r in got if r.doc_id is None] == [0]
    assert sum(v[1] for v in expected.values()) > 200


def test_suffix_automaton():
    rng = random.Random(5)
    sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 15))] for _ in range(25)]
    automaton = substring_dedup.SuffixAutomaton()
    for mark, s in enumerate(sequences):
        automaton.add(s, 100 - mark)
    automaton.finish()
    holders = defaultdict(list)
    for mark, s in enumerate(sequences):
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                holders[tuple(s[a:b])].append(100 - mark)
    for most in (3, 50):
        text = [rng.randrange(4) for _ in range(80)]
        for k, (size, mark) in enumerate(automaton.matching(text, most)):
            longest = next((n for n in range(min(most, k + 1), 0, -1) if tuple(text[k + 1 - n : k + 1]) in holders), 0)
            assert size == longest
            assert mark == (min(holders[tuple(text[k + 1 - size : k + 1])]) if size else None)


# -- embeddings --------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(7)
    rows = [rng.normal(size=16) for _ in range(120)]
    rows += [r + rng.normal(size=16) * s for r in rows[:20] for s in (0.02, 0.08, 0.1)] + rows[:5] + [3 * rows[6]]
    chain = [np.r_[math.cos(t), math.sin(t), np.zeros(14)] for t in np.arange(12) * 0.3]
    rows = [r.astype(np.float32).tolist() for r in rows + chain]
    return rows + [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_against_brute_force(spark, kind):
    rows = vectors()
    ids = list(range(50, 50 + len(rows)))
    random.Random(1).shuffle(ids)
    good = {i: np.array(v, float) for i, v in zip(ids, rows, strict=True) if v and None not in v and np.isfinite(v).all() and any(v)}
    cos = lambda a, b: float(a @ b / math.sqrt(float(a @ a)) / math.sqrt(float(b @ b))) if len(a) == len(b) else -1
    links = [(a, b) for a in good for b in good if a < b and cos(good[a], good[b]) >= 0.95]
    counts = defaultdict(int)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    expected = least_reachable(ids, links)
    df = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, rows, strict=True)], f"vec_id long, embedding array<{kind}>, kept string")
    got = embedding_dedup.near_duplicates(df, block_rows=40).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (counts[i], expected[i], expected[i] == i) for i in ids}


def test_error_bounds_hold():
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(300, 64))
    unit /= np.sqrt((unit**2).sum(1))[:, None]
    codes, scales, errors = embedding_dedup.quantised(unit)
    rounded = codes * scales[:, None]
    sizes = np.sqrt((rounded**2).sum(1))
    bound = rounded @ rounded.T + np.outer(errors, sizes + errors) + np.outer(sizes, errors)
    assert codes.dtype == np.int8
    assert (unit @ unit.T <= bound + 1e-12).all()


@pytest.mark.parametrize("parts", [3, 64, 1024, 1025, 2500])
def test_bounds_come_from_exact_products_of_codes(parts):
    rng = np.random.default_rng(parts)
    full = rng.normal(size=(60, parts)) * np.exp(rng.normal(size=(60, 1)) * 3)
    full[1], full[2], full[3] = full[0] * 2, full[0] + 1e-3 * rng.normal(size=parts), np.sign(full[0])
    table = pa.table({"rep": list(range(60)), "weight": [1] * 60, "packed": [v.tobytes() for v in full]})
    x = embedding_dedup.Block(table, "f8")
    bounds = x.bounds(slice(5, 60), x, 2)
    integers = x.codes.astype(np.int64) @ x.codes.astype(np.int64).T
    exact = integers * np.outer(x.scales, x.scales) + np.outer(x.errors, x.sizes + x.errors) + np.outer(x.sizes, x.errors)
    assert np.abs(bounds - exact[5:60, 2:]).max() < embedding_dedup._SLACK
    unit = full / np.sqrt((full**2).sum(1))[:, None]
    assert (bounds - (unit @ unit.T)[5:60, 2:]).min() > -embedding_dedup._SLACK


def test_vectors_that_share_an_id_are_one_vertex(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [1.0, 0.01, 0.0]), (3, [0.01, 1.0, 0.0]), (4, [0.0, 0.0, 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got.collect()) == [(1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4)]


def test_embeddings_whose_squares_do_not_fit_a_double(spark):
    rows = [[1e200, 0.0], [1e200, 1e198], [1e-200, 0.0], [3e-300, 3e-302], [0.0, 1e300], [0.0, 1e-320], [1.0, 1.0], [0.0, 0.0], [float("inf"), 1.0]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {0: (3, 0), 1: (3, 0), 2: (3, 0), 3: (3, 0), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


# -- shared parts ----------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(8)
    edges = [(k, k + 1) for k in range(0, 40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(90)] + [(7, 7), (500, 499), (499, 500), (None, 3)]
    nodes = {n for a, b in edges if a != b and a is not None for n in (a, b)}
    expected = least_reachable(nodes, [e for e in edges if None not in e])
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.component for r in components(df, Scratch(spark, "t")).collect()} == expected
    assert components(df.limit(0), Scratch(spark, "t")).isEmpty()
    forest = Forest(300)
    pairs = np.array([e for e in edges if None not in e and max(e) < 300])
    forest.add(pairs[:, 0], pairs[:, 1])
    held = [(int(a), int(b)) for e in forest.edges for a, b in zip(*e, strict=True)]
    assert least_reachable(range(300), held) == least_reachable(range(300), pairs.tolist())
    assert len(held) == 300 - len(set(least_reachable(range(300), held).values()))


# -- hashes -----------------------------------------------------------------------


def thue_morse(a: str, b: str, doublings: int) -> tuple[str, str]:
    """Two texts that every polynomial modulo a power of two takes for one another, if they are long enough."""
    x, y = a, b
    for _ in range(doublings):
        x, y = x + y, y + x
    return x, y


def test_hashes_tell_texts_apart_that_polynomials_do_not():
    x, y = thue_morse("a", "b", 11)
    data = np.frombuffer((x + y).encode(), np.uint8)
    starts, ends = np.array([0, len(x)]), np.array([len(x), 2 * len(x)])
    assert len(set(B.digests(data, starts, ends)[:, 0].tolist())) == 2
    for seed in range(5):
        spans = B.Spans(seed)
        assert len(set(spans.of_bytes(data, starts, ends).tolist())) == 2
        assert len(set(spans.of_values(spans.table[data], starts, ends).tolist())) == 1  # the reason for the other hash
        # A span has one hash wherever it stands.
        at = np.array([0, 3, len(x) + 5])
        alone = [spans.of_bytes(data[a : a + 40], np.array([0]), np.array([40]))[0] for a in at]
        assert spans.of_bytes(data, at, at + 40).tolist() == [int(h) for h in alone]


def test_lines_and_words_with_such_texts(docs_of):
    x, y = thue_morse("a", "b", 11)
    rows = [(k, x) for k in range(4)] + [(4, y)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.deduplicated(docs_of(rows, awkward=False)).collect()}
    assert got == dict.fromkeys(range(5), 0)
    rows = [(1, f"{x} c"), (2, f"{y} c"), (3, f"{x} c"), (4, f"d {x}")]
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in near_dedup.near_duplicates(docs_of(rows, awkward=False)).collect()}
    assert got == {1: (1, 1), 2: (2, 1), 3: (1, 1), 4: (4, 1)}
    words = [f"w{k}" for k in range(5)]
    rows = [(1, " ".join([*words, x, *words])), (2, " ".join([*words, y, *words])), (3, " ".join([*words, x, *words]))]
    got = {r.doc_id: r.n_removed for r in substring_dedup.deduplicated(docs_of(rows, awkward=False), window=11).collect()}
    assert got == {1: 0, 2: 0, 3: 11}
    p, q = (t.replace("a", "left ").replace("b", "right ") for t in thue_morse("a", "b", 11))
    rows = [(1, f"{p} one"), (2, f"{q} two"), (3, f"three {q}")]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.deduplicated(docs_of(rows, awkward=False), window=13).collect()}
    assert got == {i: (2049, n) for i, n in plain_removals(rows, 13).items()}


def plain_removals(rows, window):
    first = {}
    for i, text in sorted(rows):
        w = text.split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    result = {}
    for i, text in rows:
        w = text.split()
        gone = {k + d for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for d in range(window)}
        result[i] = len(gone)
    return result


def test_columns_named_like_those_used_inside(spark):
    line = "a line that is long enough to be dropped where it repeats often"
    rows = [(k, f"{line}\nown {k}", k, "v", "K", "t", "s") for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _keep int, _version string, _KEEP_ string, _text string, _starts string")
    lines = line_dedup.deduplicated(df)
    assert set(df.columns) <= set(lines.columns)
    assert {(r._keep, r._version, r._KEEP_, r._text, r._starts, r.n_dropped) for r in lines.collect()} == {(k, "v", "K", "t", "s", int(k < 5)) for k in range(6)}
    words = substring_dedup.deduplicated(df, window=5)
    assert set(df.columns) <= set(words.columns)
    assert {(r._keep, r._version, r._KEEP_, r._text, r._starts, r.n_removed > 0) for r in words.collect()} == {(k, "v", "K", "t", "s", k > 0) for k in range(6)}


def test_empty_tables(docs_of, spark):
    none = docs_of([], False)
    assert line_dedup.deduplicated(none).isEmpty()
    assert near_dedup.near_duplicates(none).isEmpty()
    assert substring_dedup.deduplicated(none).isEmpty()
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(empty).isEmpty()


def test_repeated_rows(docs_of):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (1, text), (2, text), (2, "other words"), (2, text)]
    lines = line_dedup.deduplicated(docs_of(rows, False), min_docs=2).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in lines) == [(1, 1), (1, 1), (2, 0), (2, 0), (2, 0)]
    near = near_dedup.near_duplicates(docs_of(rows, False)).collect()
    assert len(near) == 5 and {r.component_id for r in near if r.n_shingles > 5} == {1}
    parts = substring_dedup.deduplicated(docs_of(rows, False)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in parts) == [(1, 0), (1, 0), (2, 0), (2, 30), (2, 30)]
