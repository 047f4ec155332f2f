"""The pipeline stage by stage against brute force, and as a whole."""

import random

import pytest

import corpus_pipeline
from seamline.llm import mixing
from tests.llm.test_mixing import by_hand
from tests.llm.test_pairs import brute
from tests.llm.test_text import base_spans, contamination, spoken


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(9)
    rows = [(i, t, lang, f"s{i % 4}", len(t)) for i, t, lang in spoken()]
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    item = words(30)
    copy = "the house " + words(60) + " and the garden with this town"
    rows += [(300, copy, "en", "s0", 1), (301, copy, "en", "s1", 1), (302, copy + " town", None, None, 1), (302, copy + " town", None, None, 1)]
    rows += [(310, "the house and " + item + " the garden of the town", "en", "s2", 1)]
    rows += [(320, "the house of ann@mail.example and the garden +1 (017) 555-7713", "en", "s3", 1)]
    rows += [(330, None, "en", "s3", 0), (331, "12 34", None, "s3", 5), (None, "the garden of the town with this house", "en", None, 1)]
    d = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), item


def test_stages_by_brute_force(spark, tables, tmp_path):
    d, item = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns
        outs.append((before.collect(), docs.collect()))
    (_, known), (_, single), (_, clean), (_, private), (source, mixed) = outs
    assert {r["doc_id"] for r in known} == {*range(240), 300, 301, 302, 310, 320, None}
    groups = brute([(r["doc_id"], r["text"]) for r in known if r["doc_id"] is not None], 5, 80)
    assert sorted(r["doc_id"] for r in single if r["doc_id"] is not None) == sorted({d_ for d_, _, c in groups if d_ == c})
    assert 301 not in {r["doc_id"] for r in single} and None in {r["doc_id"] for r in single}
    bad = {x[0] for x in contamination([(r["doc_id"], r["text"]) for r in single if r["doc_id"] is not None], [(1, item)]) if x[5]}
    assert bad == {310} and {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - bad
    assert not any(base_spans(r["text"]) for r in private)
    plain = {r["doc_id"]: r["text"] for r in clean}
    assert all(r["text"] == plain[r["doc_id"]] for r in private if not base_spans(plain[r["doc_id"]]))
    _, target = by_hand([(r["doc_id"], r["text"], r["source"]) for r in source])
    taken = {}
    for r in mixed:
        taken[r["source"]] = taken.get(r["source"], 0) + len(r["text"].split())
    assert all(abs(taken.get(s, 0) - t) < 3 * mixing.PACKET for s, t in target.items())


def test_run(spark, tables):
    d, _ = tables
    first = sorted(map(tuple, corpus_pipeline.run(spark, d).collect()), key=repr)
    assert first and first == sorted(map(tuple, corpus_pipeline.run(spark, d).collect()), key=repr)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
