"""Quality classifier: averaged vectors of hashed words and character n-grams with a softmax on top.

Every word and every character n-gram (3 to 5, within words and their borders) of a text falls into one
of 2^17 buckets, each of which has a learned vector of 16 numbers; so does every repetition of the
word before. A document is the mean of its
vectors. Vectors and output weights are trained together by stochastic gradient descent in numpy, on
a sample of at most SAMPLE documents of each label, whose features the executors compute. The output
is then shifted from the sample's share of labels to that of all labelled documents.

Since the output is linear in the mean, vectors and weights fold into one number per bucket for
scoring: half a megabyte that every task gets, whatever the data's size.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import training, words

BUCKET_BITS, DIMENSIONS, GRAMS = 17, 16, (3, 4, 5)
SAMPLE, STEPS, MAX_EPOCHS, RATE = 1500, 18_000, 60, 0.5
ACCEPT = 0.3
REPEAT, REPEAT_WEIGHT = np.uint64(0x5851F42D4C957F2D), 4


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every word and character n-gram of a text."""
    if not text:
        return np.zeros(0, np.int64)
    data = np.frombuffer(text.encode(), np.uint8)
    hashed = words.hashes(data, *words.spans(data))
    # A word that repeats the one before it is a feature of its own, whatever the word.
    again = np.count_nonzero(hashed[1:] == hashed[:-1])
    found = [hashed, np.full(REPEAT_WEIGHT * again, REPEAT, np.uint64)]
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    space = (codes < 256) & words.SPACE[np.minimum(codes, 255)]
    codes = np.where(space, np.uint32(32), codes).astype(np.uint64) + np.uint64(1)
    inner = np.concatenate([[0], np.cumsum(space)])
    for size in GRAMS:
        rolled = words.rolling(codes, size)
        if len(rolled):
            # No white space but at the ends, where it stands for the border of a word.
            whole = inner[size - 1 : size - 1 + len(rolled)] == inner[1 : 1 + len(rolled)]
            found.append(words.mix(rolled[whole] + np.uint64(size)))
    return (np.concatenate(found) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


@dataclass
class Model:
    """`weight` of every bucket and `bias`, in logits of label 1; `vectors` and `output` as trained."""

    weight: np.ndarray
    bias: float
    vectors: np.ndarray | None = None
    output: np.ndarray | None = None

    def score(self, text: str | None) -> float:
        found = buckets(text)
        logit = self.bias + (float(self.weight[found].mean()) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], prior: float, seed: int = 1) -> Model:
    """Stochastic gradient descent over rows of (buckets, counts, label); `prior` is label 1's true share."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    share = np.mean([label for *_, label in rows]) if rows else 0.0
    shift = log(prior / (1 - prior)) if 0 < prior < 1 else (6.0 if prior >= 1 else -6.0)
    if not 0 < share < 1:  # nothing to tell apart
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), shift, vectors, output)
    epochs = min(MAX_EPOCHS, ceil(STEPS / len(rows)))  # small samples are passed more often
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, count, label = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(at):
                continue
            part = (count / count.sum()).astype(np.float32)
            mean = part @ vectors[at]
            logits = mean @ output + bias
            odds = np.exp(logits - logits.max())
            error = odds / odds.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(mean, error)
            bias -= rate * error
            vectors[at] -= rate * part[:, None] * back
    weight = vectors @ (output[:, 1] - output[:, 0])
    return Model(weight, float(bias[1] - bias[0]) + shift - log(share / (1 - share)), vectors, output)


def fit(docs: DataFrame, labels: DataFrame, label_column: str = "quality", folds: int = 5, held_out: int = 0) -> Model:
    """The model learned from labelled documents outside the held-out fold."""
    known = training.one_label(labels, label_column).where(training.fold(F.col("doc_id"), folds) != held_out)
    total = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = training.sample(known, "label", SAMPLE)

    # As bytes, which reach the driver as they are and not as lists of objects.
    @F.pandas_udf("at binary, count binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        pairs = [np.unique(buckets(t), return_counts=True) for t in texts]
        return pd.DataFrame({name: [p[k].astype("<i4").tobytes() for p in pairs] for k, name in enumerate(("at", "count"))})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The chosen ids are 2 * SAMPLE at most, so they go to the documents and not the other way round;
    # of repeated ids one text is learned from.
    sampled = training.one_text(texts.join(F.broadcast(chosen), "doc_id"), ["doc_id", "label"])
    rows = sampled.select("doc_id", "label", features("text").alias("f")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    trained = [
        (np.frombuffer(f["at"], "<i4"), np.frombuffer(f["count"], "<i4"), label) for f, label in zip(rows.f, rows.label)
    ]
    count = sum(total.values())
    return train(trained, total.get(1, 0) / count if count else 0.5)


def scores(docs: DataFrame, labels: DataFrame, label_column: str = "quality", folds: int = 5, held_out: int = 0) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score of label 1 and predicted (1 from 0.3 on).

    Null and empty texts have no features and get the score of the labels' overall share; without any
    usable label every score is 0.5. Repeated rows get equal scores. A null doc_id is not held out.
    Only the columns doc_id and text of `docs` are read.
    """
    model = fit(docs, labels, label_column, folds, held_out)
    known = docs.sparkSession.sparkContext.broadcast(Model(model.weight, model.bias))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = known.value
        return pd.Series([own.score(t) for t in texts], dtype=float)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score"))
    is_out = F.coalesce(training.fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return own.select("doc_id", is_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
