"""The pipeline's stages on their own inputs, and as a whole on the smallest data."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from barline.llm import classifier, exact, mixing, packing, simhash
from barline.llm.common import table
from barline.llm.queries import ORACLE, QUERIES


def test_every_stage_on_odd_texts(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, odd, str(tmp_path))
        assert kept.columns == odd.columns, name
        assert {r.doc_id for r in kept.select("doc_id").collect()} <= {
            r.doc_id for r in odd.select("doc_id").collect()
        }


def test_every_stage_on_an_empty_table(spark, no_docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).collect() == []


def test_a_second_run_leaves_the_result_of_the_first(spark, folder):
    first = corpus_pipeline.run(spark, folder)
    second = corpus_pipeline.run(spark, folder)
    assert sorted(first.collect()) == sorted(second.collect())


def test_stages_one_after_the_other_leave_what_a_run_reads(spark, folder, tmp_path):
    whole = corpus_pipeline.run(spark, folder)
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert sorted(docs.collect()) == sorted(whole.collect())


def test_stages_decide_as_their_operators(spark, folder, tmp_path):
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    scores = classifier.quality_scores(docs, labels).collect()
    kept = classifier.accepted(docs, labels).cache()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scores if r.predicted}
    verdicts = exact.exact_duplicates(kept).collect()
    once = exact.without_copies(kept).cache()
    assert {r.doc_id for r in once.collect()} == {r.doc_id for r in verdicts if r.kept}
    groups = simhash.near_duplicates(once).collect()
    apart = simhash.one_of_each(once).cache()
    assert {r.doc_id for r in apart.collect()} == {r.component_id for r in groups}
    copies = {r.doc_id: r.taken // r.size for r in mixing.mixed(apart).collect() if r.taken}
    mixed = mixing.mix_documents(apart)
    assert Counter(r.doc_id for r in mixed.collect()) == copies

    pieces = corpus_pipeline.run(spark, folder).collect()
    tokens = Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
    whole = {p.doc_id: p.doc_tokens for p in pieces}
    assert tokens == {i: n * whole[i] for i, n in copies.items()}
    assert packing.packed(mixed).count() == len(pieces)


def test_every_operator_has_a_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert numbers == list(range(1, 14))
    assert {int(name[2:].split("_")[0]) for name in ORACLE} == {3, 6, 9, 11, 12}
