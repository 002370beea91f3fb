"""Source divergence, licence signatures and whitening against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from voltmark.llm import license_rules, license_scan, source_audit, whitening

DOCS = "doc_id long, text string, lang string, source string, term string, n long, rank int, value long"


# -- source divergence -------------------------------------------------------------


def divergences(rows, min_docs, top):
    """The same by the definition, term by term."""
    counts, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", plain)
        counts[lang or "", source or ""].update(terms)
        held[lang or ""].update(set(terms))
    out = set()
    for lang in held:
        kept = [t for t, n in held[lang].items() if n >= min_docs]
        groups = {s: c for (of, s), c in counts.items() if of == lang}
        whole = sum(groups.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c[k] for k in kept) + len(kept))

        for source, c in groups.items():
            pairs = [
                (sum((share(c, t) - share(d, t)) ** 2 // share(d, t) for t in kept), other)
                for other, d in groups.items()
                if other != source
            ]
            terms = [
                ((share(c, t) - share(whole, t)) ** 2 // share(whole, t), t)
                for t in kept
                if c[t] and share(c, t) > share(whole, t)
            ]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])}
    return out


@pytest.fixture(scope="module")
def sourced():
    chance = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "aÉz" for b in ("", "b", "ß", "中", "𝒳", "cc")]
    rows = []
    for k in range(120):
        words = [chance.choice(vocabulary[: 4 + k % 15]).upper() if k % 3 else chance.choice(vocabulary) for _ in range(k % 40)]
        rows.append((chance.choice([" ", "\n", "3", "-"]).join(words), ["en", "de", None][k % 3], f"s{k % 7}" if k % 11 else None))
    rows += [("many many many many " * 50, "en", "s1")] * 5  # copies in one source
    rows += [(None, "en", "silent"), ("", "fr", "alone"), ("12 34 !", "fr", "other"), (None, None, None), ("once", "fr", "alone")]
    return rows


@pytest.mark.parametrize(("tile_terms", "tile_sources", "top"), [(1 << 13, 64, 200), (2, 3, 4), (3, 1, 1)])
def test_divergence(spark, sourced, monkeypatch, tile_terms, tile_sources, top):
    monkeypatch.setattr(source_audit, "TILE_TERMS", tile_terms)
    monkeypatch.setattr(source_audit, "TILE_SOURCES", tile_sources)
    rows = [(k, text, lang, source, "x", 1, 2, 3) for k, (text, lang, source) in enumerate(sourced)]
    got = source_audit.divergence(spark.createDataFrame(rows, DOCS).repartition(3), min_docs=3, top=top)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["lang string", "source string", "part string", "item string", "value bigint", "rank int"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got))
    assert set(got) == divergences(sourced, 3, top)


def test_divergence_of_nothing(spark):
    assert source_audit.divergence(spark.createDataFrame([], DOCS)).collect() == []
    alone = source_audit.divergence(spark.createDataFrame([(1, "a b", "en", "s", "x", 1, 2, 3)], DOCS))
    assert alone.collect() == []


def test_shares_of_huge_counts_are_exact(spark):
    n, total, vocabulary = 8 * 10**17, 9 * 10**17, 12345
    df = spark.createDataFrame([(n, total, vocabulary)], "n long, total long, vocabulary long")
    share = source_audit.share(*(df[c] for c in ("n", "total", "vocabulary")))
    assert df.select(share).first()[0] == 1 + 10**9 * (n + 1) // (total + vocabulary)


def test_counts_are_sent_in_parts(monkeypatch, sourced):
    def counted():
        batch = pa.RecordBatch.from_pylist([{"lang": a or "", "source": s or "", "text": t or ""} for t, a, s in sourced])
        n, docs = Counter(), Counter()
        for part in source_audit._counted(iter([batch.slice(0, 50), batch.slice(50)])):
            part.validate(full=True)
            for row in part.to_pylist():
                n[row["lang"], row["source"], row["term"]] += row["n"]
                docs[row["lang"], row["source"], row["term"]] += row["docs"]
        return n, docs

    whole = counted()
    monkeypatch.setattr(source_audit, "HELD_TERMS", 1)
    monkeypatch.setattr(source_audit, "PIECE_BYTES", 5)
    assert counted() == whole


# -- licences ----------------------------------------------------------------------

RULES = license_rules.all_rules()


def detections(text):
    """Every rule at every word, then every detection against every other."""
    plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)
    hits = []
    for at, word in enumerate(words):
        for number, rule in enumerate(RULES):
            if rule.keyword != word:
                continue
            on = re.match(f"({rule.on}) ", " ".join(words[at : at + license_rules.WORDS_ON]) + " ")
            ahead = re.search(f"(?:^| )({rule.ahead})$", " ".join(words[max(0, at - license_rules.WORDS_AHEAD) : at]))
            if on and (ahead or not rule.ahead):
                start = at - (len(ahead[1].split(" ")) if rule.ahead else 0)
                hits.append((start, at + len(on[1].split(" ")), number))

    def rank(hit):
        return RULES[hit[2]].priority, hit[1] - hit[0], -hit[2]

    best = [d for d in hits if not any(e[0] <= d[0] and e[1] >= d[1] and rank(e) > rank(d) for e in hits)]
    base = [h for h in hits if RULES[h[2]].priority == 0]
    labels = {RULES[h[2]].label for h in base}
    return (
        len(words), len(base), min((h[0] for h in base), default=None), max((h[0] for h in base), default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | {RULES[h[2]].label for h in best})),
        max((RULES[h[2]].weight for h in base + best), default=0.0),
        sorted((a, b, RULES[n].label, RULES[n].kind) for a, b, n in best),
    )


TEXTS = [
    "Licensed under the Apache License, Version 2.0 (the License)",
    "mit license MIT-License, mit  LICENSE mit licence",
    "GNU General Public License gnu general public license version 3 or later; GNU GPL v2",
    "released under the terms of the GNU Lesser General Public License v2.1 and cc by cc by-sa 4.0",
    "SPDX-License-Identifier: GPL-2.0-or-later\nSPDX-License-Identifier: MIT-0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. All rights reserved.",
    "this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "Neither the name of the Example Corp. nor the names of its contributors may be used to endorse",
    "https://creativecommons.org/licenses/by-nc/4.0/ and http://www.apache.org/licenses/LICENSE-2.0",
    "mitlicense mit-éa license apache license licensé ccby",
    "the license of a licence is licensed under license license license",
    None, "", " ... \n", "license", "mit", "cc by", "一 mit license 二",
]


@pytest.fixture(scope="module")
def licensed():
    chance = random.Random(12)
    pool = ["mit", "license", "licence", "licensed", "under", "the", "gnu", "general", "public", "version", "2", "3", "0", "gpl", "cc", "by", "sa", "apache", "bsd", "clause", "terms", "of", "creative", "commons"]
    texts = TEXTS + [" ".join(chance.choice(pool) for _ in range(chance.randrange(1, 60))) for _ in range(80)]
    return texts + [" ".join(t for t in TEXTS if t) * 2, TEXTS[0]]


def test_licenses(spark, licensed):
    # Ids that are null or stand twice, and columns named like results and like what the operator uses inside.
    rows = [(None if k % 9 == 0 else k // 2, t, k, "r", "w", 7, "b", "f") for k, t in enumerate(licensed)]
    df = spark.createDataFrame(rows, "doc_id long, text string, k long, row string, words string, n_words int, best string, found string")
    got = license_scan.scanned(df.repartition(3))
    assert got.columns == ["doc_id", "text", "k", "row", "words", "best", "found", *license_scan.RESULTS]
    got = {r.k: r for r in got.collect()}
    assert len(got) == len(licensed)
    for k, text in enumerate(licensed):
        r = got[k]
        found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, sorted(tuple(x) for x in r.licenses))
        assert found == detections(text), text
        assert (r.text, r.row, r.words, r.doc_id) == (text, "r", "w", None if k % 9 == 0 else k // 2)


def test_what_licenses_are_found(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in license_scan.scanned(df, keep_text=False).collect()}
    expected = {0: "apache,apache-2.0", 1: "mit", 2: "gpl,gpl-2.0,gpl-3.0", 3: "cc-by,cc-by-sa-4.0,lgpl-2.1", 4: "gpl-2.0,mit-0", 5: "mit,proprietary", 7: "bsd-3-clause", 8: "apache-2.0,cc-by-nc-4.0", 11: ""}
    assert {k: labels[k] for k in expected} == expected


def test_licenses_of_long_and_of_no_texts(spark):
    line = "licensed under the mit license and the apache license version 2 0 \n"
    df = spark.createDataFrame([(1, line * 20000)], "doc_id long, text string")
    r = license_scan.scanned(df, keep_text=False).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels) == (240_000, 40_000, 3, 239_995, "apache,apache-2.0,mit")
    assert len(r.licenses) == 40_000
    assert license_scan.scanned(df.where("false")).collect() == []


def test_rules_are_sound():
    assert len(RULES) > 300
    assert len({r.label for r in RULES}) > 90
    for r in RULES:
        assert re.fullmatch("[0-9a-z]+", r.keyword), r
        assert r.on.split(" ")[0].split("(")[0] == r.keyword
        re.compile(r.ahead), re.compile(r.on)
        # Longest forms fit the words that are looked at.
        assert len(re.sub(r"[()?]", "", r.on).split(" ")) <= license_rules.WORDS_ON


# -- whitening ---------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, component string, n string, whitened string"


def checked(got, vectors, components):
    """Rows of vectors of one length, by vector, against numpy's eigenvectors."""
    x = np.array([[math.floor(64 * c) + 10**6 for c in v] for _, v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart.astype(float) / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:components]
    trace = np.trace(covariance)
    real = [k for k, e in enumerate(values) if e > 1e-9 * values[0]]
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id].append(r)
    table = []
    for i, (vec_id, _) in enumerate(vectors):
        rows = sorted(by_id[vec_id], key=lambda r: r.component)
        assert [r.component for r in rows] == list(range(1, min(components, x.shape[1]) + 1))
        assert {r.n for r in rows} == {n}
        assert {r.deviation for r in rows} == {d if (d := sum(int(a) ** 2 for a in apart[i])) < 2**63 else None}
        for k, r in enumerate(rows):
            assert (r.whitened is None) == (k not in real)
            assert r.explained == pytest.approx(values[k] / trace if trace and k in real else 0.0, rel=1e-9)
            assert r.identity_error <= 1e-9
        table.append([r.whitened or 0.0 for r in rows])
    white = np.array(table)[:, real]
    assert np.allclose(white.T @ white / n, np.eye(len(real)), atol=1e-9)
    # The projection keeps what the components explain: scaled back, products with the data give the eigenvectors.
    axes = centred.T @ white / n / np.sqrt(values[real])
    assert np.allclose(covariance @ axes, axes * values[real], atol=1e-9 * (values[0] if len(values) else 1))


def test_whitening(spark):
    chance = np.random.default_rng(13)
    spread = chance.standard_normal((400, 24)) * np.exp(chance.standard_normal(24))
    good = [(k, v.tolist()) for k, v in enumerate(spread)]
    flat = [(1000 + k, [v[0], v[1], 2.0, v[0]]) for k, v in enumerate(spread[:50].tolist())]
    bad = [(2000, None), (2001, [None] * 24), (2002, [math.nan] * 24), (2003, [math.inf] + [0.0] * 23), (2004, [1e300] * 24), (2005, [])]
    rows = [(i, v, "c", "n", "w") for i, v in good + flat + bad]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = whitening.whitened(df, components=8)
    assert [n for n, _ in got.dtypes] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    got = got.collect()
    checked([r for r in got if r.vec_id < 1000], good, 8)
    checked([r for r in got if 1000 <= r.vec_id < 2000], flat, 8)
    assert not [r for r in got if r.vec_id >= 2000]


def test_whitening_of_few_equal_and_no_vectors(spark):
    def result(rows, kind="array<float>"):
        return whitening.whitened(spark.createDataFrame(rows, f"vec_id long, embedding {kind}"), components=4).collect()

    assert result([]) == []
    same = result([(None, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0])])
    assert len(same) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(3, 0, None, 0.0, 0.0)}
    two = result([(1, [0.0, 0.0, 0.0]), (2, [3.0, 4.0, 0.0])])
    assert {(r.vec_id, r.component, r.whitened is None) for r in two} == {(v, c, c > 1) for v in (1, 2) for c in (1, 2, 3)}
    assert sorted(r.whitened for r in two if r.component == 1) == pytest.approx([-1.0, 1.0])
    assert [r.explained for r in two if r.component == 1] == pytest.approx([1.0, 1.0])


def test_whitening_of_huge_entries(spark):
    # Sums and squares that no long holds.
    chance = random.Random(5)
    vectors = [(k, [chance.uniform(-1e17, 1e17) for _ in range(3)]) for k in range(40)]
    got = whitening.whitened(spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3), 3)
    checked(got.collect(), vectors, 3)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 60])
def test_eigenvectors(size):
    chance = np.random.default_rng(size)
    x = chance.standard_normal((200, size)) * np.exp(chance.standard_normal(size))
    turned = np.linalg.qr(chance.standard_normal((size, size)))[0]
    clusters = turned @ np.diag(np.repeat([5.0, 2.0, 2.0 + 1e-10, 1.0], size)[:size]) @ turned.T
    for matrix in (x.T @ x, np.eye(size) * 3, clusters, 1e150 * clusters, 1e-150 * clusters):
        axes, explained = whitening.axes(matrix, 32)
        values = np.linalg.eigvalsh(matrix)[::-1][:32]
        assert np.allclose(explained * np.trace(matrix), values, rtol=1e-10, atol=1e-13 * values[0])
        assert np.allclose(axes.T @ matrix @ axes, np.eye(len(values)), atol=1e-9)
        vectors = axes * np.sqrt(values)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)


def test_sturm_counts():
    diagonal, beside = np.array([2.0, 0.0, -1.0, 0.0, 4.0]), np.array([1.0, 0.0, 0.5, 0.0])
    values = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
    at = np.array([-9.0, *(values - 1e-9), *(values + 1e-9), 9.0])
    assert whitening.below(diagonal, beside, at).tolist() == [int((values < a).sum()) for a in at]
