"""The pipeline's stages against plain Python, each on its own input; and what the registered queries promise."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from llm_fixtures import corpus  # noqa: F401
from test_dedup_operators import least_reachable, plain_lines, shingles
from test_text_operators import plain_contamination
from voltmark.llm import quality
from voltmark.llm.oracles import ORACLES
from voltmark.llm.queries import QUERIES
from voltmark.llm.scratch import Scratch, shared_folder


@pytest.fixture(scope="module")
def sf_dir(spark, corpus, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(12)
    junk = [" ".join(rng.choice(["###", "xx%%", "A!!", "0"]) for _ in range(40)) for _ in range(60)]
    docs = [(i, t, "en", "s", len(t)) for i, t in corpus] + [(1000 + k, t, None, "s", len(t)) for k, t in enumerate(junk)] + [(5, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in corpus[:80]] + [(1000 + k, 0, 0) for k in range(50)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(corpus[40][1].split()[2:16])), (2, "words that stand nowhere")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, sf_dir):
    scratch = Scratch(spark, "t")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    (_, by_quality), (_, by_lines), (_, by_copies), (_, by_items), (_, into_tokens) = corpus_pipeline.STAGES

    def rows(df):
        return {r.doc_id: r for r in df.collect()}

    first = scratch.store(by_quality(spark, docs, sf_dir))
    model = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    all_docs = rows(docs)
    scores = dict(zip(all_docs, model.scores(quality.features(pa.array([r.text for r in all_docs.values()]))), strict=True))
    kept = rows(first)
    assert set(kept) == {i for i, s in scores.items() if s >= 0.3} and first.columns == names
    assert not any(i >= 1000 for i in kept) and len(kept) > 90

    second = scratch.store(by_lines(spark, first, sf_dir))
    expected = plain_lines([(r.doc_id, r.text) for r in kept.values()])
    cleaned = rows(second)
    assert second.columns == names and set(cleaned) == set(kept)
    assert sum(len(cleaned[i].text.split("\n")) != expected[i][0] for i in cleaned) >= sum(e[1] > 0 for e in expected.values()) > 3
    assert all(r.n_chars == len(r.text) for r in cleaned.values())

    third = scratch.store(by_copies(spark, second, sf_dir))
    sets = {i: shingles(r.text, 5) for i, r in cleaned.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = least_reachable(sets, links)
    assert third.columns == names and set(rows(third)) == {i for i in sets if least[i] == i} != set(sets)

    fourth = scratch.store(by_items(spark, third, sf_dir))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {i for i, v in plain_contamination([(i, r.text) for i, r in rows(third).items()], items, 10).items() if not v[-1]}
    assert fourth.columns == names and set(rows(fourth)) == clean != set(rows(third))

    last = rows(into_tokens(spark, fourth, sf_dir))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = rows(fourth)
    assert {i: r.ids for i, r in last.items()} == {i: library.encode(r.text, add_special_tokens=False).ids for i, r in texts.items()}

    whole = rows(corpus_pipeline.run(spark, sf_dir))
    assert {i: r.ids_sha256 for i, r in whole.items()} == {i: r.ids_sha256 for i, r in last.items()}


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).isEmpty()


def test_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and "pipeline" in entry_module.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_intermediate_tables_go_to_the_shared_folder_and_away(spark):
    class Unset:
        def __init__(self, values):
            self.get = lambda name, default=None: values.get(name, default)

    class Session:
        conf = Unset({"spark.sql.warehouse.dir": "file:/w/"})

        class sparkContext:
            getConf = staticmethod(lambda: Unset({}))

    assert shared_folder(Session) == "file:/w/_checkpoints"
    Session.conf = Unset({"spark.checkpoint.dir": "hdfs://shared/c/"})
    assert shared_folder(Session) == "hdfs://shared/c"
    scratch = Scratch(spark, "t")
    assert scratch.folder.startswith(shared_folder(spark))
    one, two = scratch.store(spark.range(3)), scratch.store(spark.range(2))
    scratch.drop(one)
    assert two.count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(one.scratch_path)
    scratch.drop()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(two.scratch_path)
