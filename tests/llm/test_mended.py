"""Cases that earlier versions got wrong: few vectors, items without an id, ids with two labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattspan.llm import decontamination, toxicity, vector_search

WORDS = [f"w{k}" for k in range(40)]


@pytest.mark.parametrize("count", [1, 2, 15, 25])
def test_few_vectors_have_all_neighbours_at_the_shipped_setting(spark, count):
    rows = [(k, v.tolist()) for k, v in enumerate(np.random.default_rng(count).normal(size=(count, 8)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vector_search.search(vector_search.valid_vectors(table), vector_search.valid_vectors(table))
    per_query = {r["query_id"]: r["n"] for r in found.groupBy("query_id").agg(F.count("*").alias("n")).collect()}
    assert per_query == {k: min(20, count - 1) for k in range(count) if count > 1}


def test_recall_at_the_shipped_setting(spark):
    random = np.random.default_rng(3)
    centers = random.normal(size=(30, 16))
    vectors = centers[random.integers(0, 30, 2000)] + random.normal(size=(2000, 16))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    valid = vector_search.valid_vectors(table)
    found = vector_search.search(valid, valid.where("vec_id % 20 = 0"))
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    for q in range(0, 2000, 20):
        products = vectors @ vectors[q]
        products[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-products)[:20].tolist()))
    assert hit / (20 * 100) >= 0.9


def test_an_item_without_an_id_is_hit_but_not_named(spark):
    docs = spark.createDataFrame([(1, "a " + " ".join(WORDS[:12]) + " b"), (2, "clean")], "doc_id long, text string")
    items = spark.createDataFrame([(None, " ".join(WORDS[:12])), ("x", "none of it")], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontamination.scan(docs, items).collect()}
    assert [(s["at"], s["size"]) for s in found[1]["spans"]] == [(1, 10), (2, 10), (3, 10)]
    assert found[1]["items"] == []
    assert found[2]["spans"] == []


def test_an_id_with_two_labels_is_no_example(spark):
    docs = spark.createDataFrame([(k, f"t{k}") for k in range(40)], "doc_id long, text string")
    marks = [(k, k % 2) for k in range(40)] + [(1, 0), (3, 1), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    held = {r[0] for r in docs.where(toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()}
    chosen = toxicity.labelled_sample(docs, labels, "quality", 100, only=1)
    expected = {k for k in range(40) if k % 2 and k != 1} - held
    assert {r["doc_id"] for r in chosen.collect()} == expected


def test_toxicity_with_few_examples_and_clashing_names(spark):
    texts = [(k, f"word{k} nasty" if k % 3 == 0 else f"word{k} fine", "en", 7, 8, 9) for k in range(30)]
    odd = [(None, None, None, 1, 2, 3), (3, "again", "fr", 1, 2, 3), (5, "long " * 50_000, "en", 1, 2, 3)]
    docs = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string, toxic int, toxicity int, logit int")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(30)], "doc_id long, toxic int")
    names = toxicity.free_name(docs.columns, "toxicity"), toxicity.free_name(docs.columns, "toxic")
    judged = toxicity.scored_once(docs, labels, docs.columns, names)
    assert judged.columns == [*docs.columns, "toxicity_", "toxic_"]
    rows = judged.collect()
    assert len(rows) == 33
    assert {r["toxic"] for r in rows if r["doc_id"] == 4} == {7}
    assert all(0 <= r["toxicity_"] <= 1 for r in rows)
    none = toxicity.scored_once(docs, labels.where("false"), docs.columns, names)
    assert none.count() == 33
    assert toxicity.scored_once(docs.where("false"), labels, docs.columns, names).count() == 0


def test_convolution_and_maxima_equal_plain_loops():
    words = toxicity.Vocabulary()
    texts = ["a b c d", "one", "", "b a b a b", "x " * 12]
    arrays = [words(t) for t in texts]
    model = toxicity.train(arrays, words, np.array([1.0, 0, 0, 1, 0]), epochs=1)
    result, _, _ = model.maxima(arrays, words)
    for d, ids in enumerate(arrays):
        vectors = [model.table[words.rows[i]].sum(axis=0) for i in ids]
        for n, width in enumerate(toxicity.WIDTHS):
            best = np.zeros(toxicity.FILTERS)
            for start in range(len(ids)):
                value = model.filter_bias[width].astype(float).copy()
                for tap in range(width):
                    if start + tap < len(ids):
                        value += vectors[start + tap] @ model.filters[width][tap]
                best = np.maximum(best, value)
            columns = slice(n * toxicity.FILTERS, (n + 1) * toxicity.FILTERS)
            assert np.allclose(result[d, columns], best, atol=1e-4)
    together = model.logits(arrays, words)
    assert np.allclose(together, result @ model.out + model.bias)
    assert np.allclose(model.scores(arrays, words), 1 / (1 + np.exp(-(model.scale * together + model.shift))))


def test_rows_without_words_all_stay(spark):
    from wattspan.llm.common import digest, keep_rows

    rows = [(None, None, 1), (None, "", 2), (None, "", 3), (None, "...", 4), (7, "a b", 5), (7, "a b", 6), (None, "é", 7), (None, "é", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    named = docs.select("doc_id", digest(F.col("text")).alias("digest"))
    kept = [r["n"] for r in keep_rows(docs, named, once=True).collect()]
    assert sorted(k for k in kept if k <= 4) == [1, 2, 3, 4]
    assert len(kept) == 6
