"""Removal of repeated word windows across documents, by Rabin-Karp hashes counted in Spark.

A word goes when a window of `width` words that covers it also starts in a document with a smaller
id. Words are maximal runs without space or 0x09-0x0D; windows are judged on the input.

1. Documents with the same words are one class; the smallest id stands for it, and the others lose
   all their words if they have a window at all.
2. Each window has the smallest of its rolling hashes of `ANCHOR` words as its anchor, which equal
   windows share. Anchors are counted: a window whose anchor is in one document only is unique, so
   its own hash need not be shuffled. That leaves about one anchor for twenty words.
3. The other windows are hashed with two Rabin-Karp hashes (128 bits), and the smallest document of
   each hash is found. Windows with a smaller document than their own merge into the intervals that
   are removed.

Every step is a map over documents or an aggregation with partial sums; a window that a third of
all documents share costs each task one partial row, and joins with it are split by adaptive execution.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import words
from tickermill.session import stored

WIDTH, ANCHOR = 50, 8


def _kept_sha(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """sha256 of the given words joined by one space."""
    if not len(starts):
        return hashlib.sha256(b"").hexdigest()
    raw = data.tobytes()
    return hashlib.sha256(b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])).hexdigest()


def _anchors(hashed: np.ndarray, width: int) -> np.ndarray:
    """Anchor of every window (none for a text shorter than a window)."""
    if len(hashed) < width:
        return np.zeros(0, np.uint64)
    short = min(ANCHOR, width)
    return words.sliding_min(words.rolling(hashed, short), width - short + 1)


def _read(batches, width: int):
    """Words, digest of all words and distinct anchors of every document."""
    for batch in batches:
        rows = []
        for key, data in zip(zip(*(c.to_pylist() for c in batch.columns[:2])), words.as_bytes(batch.column(2))):
            data = np.zeros(0, np.uint8) if data is None else data
            starts, ends = words.spans(data)
            hashed = words.hashes(data, starts, ends)
            anchors = words.signed(np.unique(_anchors(hashed, width)))
            rows.append((*key, len(starts), _kept_sha(data, starts, ends), anchors))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        columns = zip(*rows) if rows else [[]] * len(types)
        names = ["doc_id", "body", "n_words", "all_sha256", "anchors"]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)


def _windows(batches, width: int):
    """Both hashes of the windows whose anchor is shared, with the document and the window's start."""
    for batch in batches:
        parts = []
        ids, bodies, seeds = (batch.column(k) for k in (0, 1, 3))
        for doc_id, body, data, seed in zip(ids.to_pylist(), bodies.to_pylist(), words.as_bytes(batch.column(2)), seeds):
            starts, ends = words.spans(data)
            hashed = words.hashes(data, starts, ends)
            wanted = np.sort(seed.values.to_numpy(zero_copy_only=False).view(np.uint64))
            anchors = _anchors(hashed, width)
            at = np.minimum(np.searchsorted(wanted, anchors), len(wanted) - 1)
            found = np.flatnonzero(wanted[at] == anchors)
            again = words.hashes(data, starts, ends, seed=1)
            parts.append(
                (
                    np.full(len(found), doc_id, np.int64),
                    np.full(len(found), body, np.int64),
                    found.astype(np.int32),
                    words.signed(words.rolling(hashed, width)[found]),
                    words.signed(words.rolling(again, width, 1)[found]),
                )
            )
        names = ["doc_id", "body", "start", "hash_a", "hash_b"]
        for k in range(0, len(parts), 64):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts[k : k + 64])], names)


def repeated_windows(
    docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(documents, starts): a row per document, and per (doc_id, body) the starts of its repeated windows.

    Documents carry doc_id, body (a hash that tells rows with one id apart), n_words, all_sha256
    and `copy`, true if a smaller document has the same words.
    """
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    keyed = narrow.select("doc_id", F.xxhash64("text").alias("body"), "text")
    found = stored(
        keyed.mapInArrow(
            lambda b: _read(b, width),
            "doc_id long, body long, n_words long, all_sha256 string, anchors array<long>",
        ),
        "read",
    )
    whole = ["all_sha256"]  # words hold no spaces, so equal digests are equal words
    first = stored(
        found.where(f"n_words >= {width} and doc_id is not null").groupBy(*whole).agg(F.min("doc_id").alias("first_id")),
        "first",
    )
    documents = stored(
        found.join(first, whole, "left").select(
            "doc_id", "body", "n_words", "all_sha256", F.coalesce(F.expr("first_id < doc_id"), F.lit(False)).alias("copy"), "anchors"
        ),
        "documents",
    )
    alone = documents.where("not copy and size(anchors) > 0 and doc_id is not null")
    anchors = alone.select("doc_id", "body", F.explode("anchors").alias("anchor"))
    shared = stored(
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select("anchor", "least"),
        "shared",
    )
    seeds = stored(
        anchors.join(shared, "anchor").groupBy("doc_id", "body").agg(F.collect_set("anchor").alias("seeds")), "seeds"
    )
    # Rows that repeat an id and a text count once here; the result is joined back to all of them.
    texts = keyed.join(seeds, ["doc_id", "body"]).dropDuplicates(["doc_id", "body"])
    windows = stored(
        texts.mapInArrow(lambda b: _windows(b, width), "doc_id long, body long, start int, hash_a long, hash_b long"),
        "windows",
    )
    earliest = stored(
        windows.groupBy("hash_a", "hash_b")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .drop("most"),
        "earliest",
    )
    later = windows.join(earliest, ["hash_a", "hash_b"]).where("least < doc_id")
    starts = stored(later.groupBy("doc_id", "body").agg(F.sort_array(F.collect_set("start")).alias("starts")), "starts")
    return documents.drop("anchors"), starts


def removal_intervals(starts: np.ndarray, width: int) -> np.ndarray:
    """Maximal half-open word intervals covered by windows with the given sorted starts."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.flatnonzero(np.diff(starts) > width) + 1
    first = starts[np.concatenate([[0], new])]
    last = starts[np.concatenate([new - 1, [len(starts) - 1]])] + width
    return np.stack([first, last], axis=1).astype(np.int64)


def _cut(data: np.ndarray, starts: np.ndarray, width: int):
    begin, end = words.spans(data)
    keep = np.ones(len(begin), bool)
    for a, b in removal_intervals(starts, width):
        keep[a:b] = False
    return begin[keep], end[keep], len(begin)


def digests(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed and kept_sha256 (kept words joined by one space).

    Null, empty and blank texts have no words; texts shorter than a window lose none; a null id has
    no order, so its row neither loses words nor makes others lose any. Rows that repeat an id are
    one document. Other columns are ignored. An empty table gives an empty result.
    """
    documents, starts = repeated_windows(docs, width, id_column, text_column)

    @F.pandas_udf("n_removed long, kept_sha256 string")
    def kept(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
        rows = []
        for text, at in zip(texts, starts):
            data = np.frombuffer(text.encode(), np.uint8)
            begin, end, total = _cut(data, np.asarray(at), width)
            rows.append((total - len(begin), _kept_sha(data, begin, end)))
        return pd.DataFrame(rows, columns=["n_removed", "kept_sha256"])

    keyed = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    keyed = keyed.withColumn("body", F.xxhash64("text"))
    cut = keyed.join(starts, ["doc_id", "body"]).dropDuplicates(["doc_id", "body"])
    cut = stored(cut.select("doc_id", "body", kept("text", "starts").alias("k")), "cut").select("doc_id", "body", "k.*")
    out = documents.join(cut, ["doc_id", "body"], "left")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), empty).otherwise(F.coalesce("kept_sha256", "all_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and text with the repeated words cut out; kept words are joined by one space."""
    documents, starts = repeated_windows(docs, width, id_column, text_column)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, starts: pd.Series) -> pd.Series:
        out = []
        for text, at in zip(texts, starts):
            data = np.frombuffer((text or "").encode(), np.uint8)
            begin, end, _ = _cut(data, np.asarray([] if at is None else at, np.int64), width)
            raw = data.tobytes()
            out.append(b" ".join([raw[a:b] for a, b in zip(begin, end)]).decode())
        return pd.Series(out, dtype=object)

    keyed = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    keyed = keyed.withColumn("body", F.xxhash64("text"))
    copies = documents.where("copy").select("doc_id", "body", "copy").distinct()
    joined = keyed.join(starts, ["doc_id", "body"], "left").join(copies, ["doc_id", "body"], "left")
    return joined.select("doc_id", F.when(F.col("copy"), "").otherwise(kept("text", "starts")).alias("text"))
