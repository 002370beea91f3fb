from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, score string, version string, n_chars long, kept string"


@pytest.fixture(scope="session")
def corpus():
    """Documents of invented words with copies, near copies, shared passages and lines; ids out of order."""
    chance = random.Random(4)
    vocabulary = ["".join(chance.choice("abcdeéß") for _ in range(chance.randrange(1, 7))) for _ in range(400)]

    def prose(n: int) -> str:
        words = [chance.choice(vocabulary) + chance.choice(["", "", "", ".", ",", "\n"]) for _ in range(n)]
        return " ".join(words)

    base = [prose(chance.randrange(20, 120)) for _ in range(60)]
    texts = list(base)
    line, passage = "This line is long enough to be a line that many pages repeat.", prose(40)
    for k in range(30):
        words = base[k].split(" ")
        for _ in range(1 + k % 9):
            words[chance.randrange(len(words))] = chance.choice(vocabulary)
        texts.append(" ".join(words))
    texts += [base[1]] * 3 + [base[2].upper(), base[3].replace(" ", "\t ")]
    texts += [f"{prose(9)}\n  {line}\t\n{prose(15)}" for _ in range(9)]
    texts += [f"{prose(12)} {passage} {prose(k)}" for k in range(7)] + [" ".join(passage.split()[5:25]) + " " + prose(5)]
    texts += ["", " \n ", "one", "one two", "ONE two", "one  two\n", prose(3000)]
    ids = list(range(10, 10 + len(texts)))
    chance.shuffle(ids)
    return [(i, t) for i, t in zip(ids, texts, strict=True)]


@pytest.fixture
def docs_of(spark):
    """A table of documents with null texts, a row without id, and columns named like what operators return."""

    def build(rows, awkward=True):
        rows = [(i, t, None, "s", "v", 1, "k") for i, t in rows]
        if awkward:
            rows += [(5, None, "en", None, None, None, None), (None, "no id here but some words", None, None, None, None, None)]
        return spark.createDataFrame(rows, DOCS).repartition(3)

    return build
