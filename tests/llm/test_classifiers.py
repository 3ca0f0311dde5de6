"""Quality, language and toxicity: held-out accuracy, folds and odd rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickermill.llm import language, quality, toxicity, training

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_quality_on_held_out_documents(tables):
    docs, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.93
    assert sum(r.predicted for r in held if truth[r.doc_id]) / sum(truth[r.doc_id] for r in held) > 0.97


def test_toxicity_on_held_out_documents(tables):
    docs, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.scores(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.9
    clean = [r for r in held if not truth[r.doc_id]]
    assert sum(r.predicted for r in clean) / len(clean) < 0.05


def test_language_on_held_out_documents(tables):
    docs, _ = tables
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.predictions(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (fold(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) / len(rows) < 0.005


def test_language_odd_rows_and_rejection(tables, odd, empty):
    docs, _ = tables
    model = language.fit(docs)
    out = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].rejected and out[i].score == 0.0 for i in (1, 2, 3, 5))
    assert out[4].lang_pred in {"en", "de", "fr", "es"} and set(odd.columns) - set(out[4].asDict()) == set()
    assert model.predict("Москва столица России и крупнейший по численности населения город страны")[2]
    assert language.predictions(empty).collect() == []
    assert {r.lang_pred for r in language.predictions(empty.union(odd.where("lang is null"))).collect()} == {"und"}


def test_scores_of_odd_rows(tables, odd, empty):
    _, labels = tables
    for operator, own in ((quality, labels), (toxicity, labels)):
        rows = operator.scores(odd, own).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 8}) == 1
        assert operator.scores(empty, own).collect() == []
        rows = operator.scores(odd, own.limit(0)).collect()
        assert len(rows) == odd.count() and len({r.score for r in rows}) == 1


def test_features_see_hidden_and_addressed_insults():
    lexicon = toxicity.Lexicon(frozenset(["blork", "zun*"]))
    at = dict(zip(toxicity.FEATURES, toxicity.features("you idiot, 1d10t BLORK zunder! stuuupid s.c.u.m", lexicon)))
    assert at["fixed_any"] == 1 and at["learned_count"] == 2 and at["second_person_near"] > 0
    assert at["hidden_words"] > 0 and at["stretched_letters"] > 0 and at["capital_runs"] > 0
    assert toxicity.features(None, lexicon) == [0.0] * len(toxicity.FEATURES) == toxicity.features("12 ..", lexicon)


def test_a_language_left_out_of_learning_is_rejected(tables):
    docs, _ = tables
    known = docs.where("lang != 'fr'")
    rows = language.identify(docs, language.fit(known)).where("length(text) > 400").collect()
    left_out = [r.rejected for r in rows if r.lang == "fr"]
    assert sum(left_out) / len(left_out) > 0.8
    own = [r.rejected for r in rows if r.lang != "fr"]
    assert sum(own) / len(own) < 0.005


def test_centroids_are_learned_from_all_documents(spark):
    import random

    rng = random.Random(3)
    words = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(30))
    rows = spark.createDataFrame([(i, words("abcdefghij"), "xx") for i in range(1200)], "doc_id long, text string, lang string")
    # Four documents of another script, none of them among those with the 300 smallest hashes.
    learned = rows.where("crc32(string(doc_id)) % 3 != 1")
    odd = [r.doc_id for r in learned.orderBy(F.xxhash64("doc_id").desc()).limit(4).collect()]
    assert not {r.doc_id for r in training.sample(learned, "lang", 300).collect()} & set(odd)
    greek = spark.createDataFrame([(i, words("αβγδε"), "xx") for i in odd], rows.schema)
    docs = rows.where(~F.col("doc_id").isin(odd)).union(greek)
    model = language.fit(docs)
    assert model.predict(words("αβγδε"))[1] > 0.5
    # Neither the order of the rows nor a repeated row changes what is learned.
    again = language.fit(docs.repartition(7))
    assert np.array_equal(model.centroids, again.centroids) and np.array_equal(model.limit, again.limit)
    short = language.fit(spark.createDataFrame([(i, "ab c", "xx") for i in range(9)], rows.schema))
    assert short.predict("ab c")[0] == "xx" and len(short.language) == 1
    grams = language._one_per_id(language._gram_rows(docs.union(docs.limit(50)).union(spark.createDataFrame([(None, "x", "xx")], rows.schema))))
    assert grams.where("doc_id is not null").count() == 1200


def test_pieces_have_the_ngrams_of_each_text_alone():
    texts = ["Der Hund, das ist!", "", "12 34", "Ωmega ΟΔΟΣ", "a", "İstanbul  x-y", "-", "日本 語"]
    number, found = language.piece_buckets(texts)
    for k, text in enumerate(texts):
        alone = language.buckets(text)
        assert sorted(found[number == k]) == (sorted(alone) if alone is not None else [])
    assert all(len(x) == 0 for x in language.piece_buckets([]))
    assert language.buckets("12 ..") is None and len(language.buckets("ab")) == 2 + 3 + 2


def test_quantiles_of_counted_steps():
    values = np.random.default_rng(4).uniform(-1, 1, 777)
    steps = np.rint(values * language.STEPS).astype(int) + language.STEPS
    counts = np.bincount(steps, minlength=2 * language.STEPS + 1)
    for share in (0, 0.002, 0.3, 0.99, 1):
        assert abs(language._quantile(counts, share) - np.quantile(values, share)) < 1 / language.STEPS


def test_samples_hold_the_smallest_hashes_and_one_row_of_an_id(spark):
    size = 1500
    rows = spark.range(60_000).selectExpr("if(id < 20000, 7, id) AS doc_id", "if(id < 50000, 'a', 'b') AS label", "id AS extra")
    chosen = training.sample(rows, "label", size)
    found = [(r.label, r.doc_id) for r in chosen.collect()]
    want = rows.select("label", "doc_id").distinct().selectExpr("*", "xxhash64(doc_id) AS h").collect()
    for label in "ab":
        least = sorted((r.h, r.doc_id) for r in want if r.label == label)[:size]
        assert sorted(i for y, i in found if y == label) == sorted(i for _, i in least)
    assert training.sample(rows.where("false"), "label", size).collect() == []
    assert {r.doc_id for r in training.sample(rows.where("id > 59990"), "label", size).collect()} == set(range(59_991, 60_000))
    texts = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None)], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in training.one_text(texts, ["doc_id"]).collect()}
    assert kept[1] in {"a", "b"} and kept[2] is None and len(kept) == 2


def test_repeated_ids_do_not_crowd_the_driver(spark):
    rows = [(1 + k % 4, f"text {k}" if k else None, "en" if k % 2 else "de") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "doc_id long, quality int")
    assert len(quality.scores(docs, labels).collect()) == len(rows)
    assert len(language.predictions(docs).collect()) == len(rows)


def plain_descent(rows, prior, seed=1):
    """The same descent without numpy's shortcuts: one weight matrix row per feature, in plain loops."""
    rng = np.random.default_rng(seed)
    size, width = 1 << quality.BUCKET_BITS, quality.DIMENSIONS
    vectors = rng.uniform(-1 / width, 1 / width, (size, width)).astype(np.float32).astype(float)
    output, bias = [[0.0, 0.0] for _ in range(width)], [0.0, 0.0]
    epochs = min(quality.MAX_EPOCHS, -(-quality.STEPS // len(rows)))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, count, label = rows[k]
            rate = quality.RATE * (1 - done / steps)
            done += 1
            total = float(sum(count))
            mean = [sum(c / total * vectors[b][d] for b, c in zip(at, count)) for d in range(width)]
            logits = [sum(mean[d] * output[d][y] for d in range(width)) + bias[y] for y in (0, 1)]
            odds = [math.exp(z - max(logits)) for z in logits]
            error = [o / sum(odds) - (y == label) for y, o in enumerate(odds)]
            back = [output[d][0] * error[0] + output[d][1] * error[1] for d in range(width)]
            for d in range(width):
                for y in (0, 1):
                    output[d][y] -= rate * mean[d] * error[y]
            bias = [bias[y] - rate * error[y] for y in (0, 1)]
            for b, c in zip(at, count):
                vectors[b] -= [rate * c / total * x for x in back]
    share = sum(label for *_, label in rows) / len(rows)
    shift = math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return vectors, output, bias[1] - bias[0] + shift


def test_descent_against_plain_loops(monkeypatch):
    monkeypatch.setattr(quality, "STEPS", 60)
    texts = [("good words here", 1), ("bad bad text", 0), ("fine words", 1), ("awful", 0), ("more good", 1)]
    rows = [(*np.unique(quality.buckets(t), return_counts=True), y) for t, y in texts]
    model = quality.train(rows, 0.3)
    vectors, output, bias = plain_descent(rows, 0.3)
    for text in ("good words", "bad text", "something else", ""):
        found = quality.buckets(text)
        mean = vectors[found].mean(axis=0) if len(found) else np.zeros(quality.DIMENSIONS)
        logit = bias + sum(mean[d] * (output[d][1] - output[d][0]) for d in range(quality.DIMENSIONS))
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-4)
