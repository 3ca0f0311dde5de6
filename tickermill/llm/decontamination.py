"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Words are runs of bytes other than ASCII punctuation, space and controls, in lower case. A document
and a benchmark item that share a seed of 5 words are tiled: the longest match of words that no tile
covers yet is marked, again and again, down to matches of 5 words. The share of the item's words under
tiles is its coverage, whatever the order of the passages in the document. A document with an item
of coverage 0.5 or more is contaminated.

The benchmark goes to the tasks in blocks of at most BLOCK_WORDS words (or one item), each read over
all documents, so what a task holds is bounded however large the benchmark is. Documents are not
shuffled; only (document, item) pairs above the threshold leave the map.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import words
from tickermill.session import stored

SEED, COVERAGE, BLOCK_WORDS = 5, 0.5, 1 << 21

# Lower-case letters, and separators turned into spaces; bytes of other alphabets stay as they are.
_PLAIN = words.LOWER.copy()
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 32


def tokens(data: np.ndarray | None) -> np.ndarray:
    """Word hashes of a text in bytes."""
    if data is None:
        return np.zeros(0, np.uint64)
    if len(data) and data.max() > 127:
        data = np.frombuffer(data.tobytes().decode().lower().encode(), np.uint8)
    data = _PLAIN[data]
    return words.hashes(data, *words.spans(data))


def _free(used: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs of `size` words without a used one."""
    total = np.concatenate([[0], np.cumsum(used)])
    return np.flatnonzero(total[size:] == total[:-size])


def _shared(doc, item, used_doc, used_item, size):
    """Free runs of `size` words that both have: (hashes in doc, starts in doc, hashes in item, starts in item)."""
    at_doc, at_item = _free(used_doc, size), _free(used_item, size)
    key_doc, key_item = words.rolling(doc, size)[at_doc], words.rolling(item, size)[at_item]
    in_doc, in_item = np.isin(key_doc, key_item), np.isin(key_item, key_doc)
    return key_doc[in_doc], at_doc[in_doc], key_item[in_item], at_item[in_item]


def _around(doc: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words in the runs of `size` that begin at `starts`, and where a new stretch begins among them."""
    inside = np.zeros(len(doc) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + size, -1)
    places = np.flatnonzero(np.cumsum(inside[:-1]))
    return places, np.flatnonzero(np.diff(places) > 1) + 1


def tile(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in doc, start in item), the longest first, ties by position.

    The longest match of free words is found by halving: wherever a match of some length is, there is one of
    every smaller length, so runs of one length at a time are hashed and compared. All of that length are
    marked, then the next shorter one is looked for. Memory is linear in both texts, however often they
    repeat themselves.
    """
    used_doc, used_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    _, starts, _, _ = _shared(doc, item, used_doc, used_item, least)
    # Only the stretches of the document that share a seed matter; a used word stands between them.
    places, cuts = _around(doc, starts, least)
    places = np.insert(places, cuts, -1)
    used, short = places < 0, doc[places]
    tiles, most = [], min(len(item), len(doc))
    while most >= least:
        low, high = least - 1, most  # a match of `low` exists (or none of `least`), none above `high`
        while low < high:
            size = (low + high + 1) // 2
            if len(_shared(short, item, used, used_item, size)[0]):
                low = size
            else:
                high = size - 1
        if low < least:
            break
        tiles += _mark(short, item, used, used_item, low)
        most = low - 1
    return [(size, int(places[i]), j) for size, i, j in tiles]


def _mark(doc, item, used_doc, used_item, size) -> list[tuple[int, int, int]]:
    """Mark the matches of `size` free words in order of their places; equal hashes are confirmed on the words."""
    key_doc, at_doc, key_item, at_item = _shared(doc, item, used_doc, used_item, size)
    order = np.argsort(key_item, kind="stable")
    first, after = (np.searchsorted(key_item[order], key_doc, side) for side in ("left", "right"))
    passed: dict[int, int] = {}  # by first place of a hash: places in the item that are used up
    tiles, free_from = [], 0
    for i, low, high in zip(at_doc.tolist(), first.tolist(), after.tolist()):
        if i < free_from:
            continue
        k = passed.get(low, low)
        while k < high and used_item[at_item[order[k]] : at_item[order[k]] + size].any():
            k += 1
        passed[low] = k
        for j in at_item[order[k:high]].tolist():
            if not used_item[j : j + size].any() and np.array_equal(doc[i : i + size], item[j : j + size]):
                used_doc[i : i + size] = used_item[j : j + size] = True
                tiles.append((size, i, j))
                free_from = i + size
                break
    return tiles


class Benchmark:
    """Seeds of a block of items, with the items and places that have them."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        seeds = [words.rolling(t, SEED) for _, t in items]
        size = [len(s) for s in seeds]
        every = np.concatenate([np.zeros(0, np.uint64), *seeds])
        order = np.argsort(every, kind="stable")
        self.seed, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.owner = np.repeat(np.arange(len(items)), size)[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *map(np.arange, size)])[order]
        # A table of low hash bits that rules out nearly all other windows.
        bits = max(10, (64 * max(1, len(self.seed)) - 1).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[self.seed & self.mask] = True

    def covered(self, doc: np.ndarray, threshold: float) -> list[tuple[int, float, int]]:
        """(item_id, coverage, tiles) of the items whose coverage reaches the threshold."""
        hashed = words.rolling(doc, SEED)
        hashed = hashed[self.maybe[hashed & self.mask]]
        if not len(hashed):
            return []
        hashed = np.unique(hashed)
        at = np.searchsorted(self.seed, hashed)
        hit = at[(at < len(self.seed)) & (self.seed[np.minimum(at, len(self.seed) - 1)] == hashed)]
        places: dict[int, list[int]] = {}
        for k in hit:
            for n in range(self.first[k], self.first[k] + self.times[k]):
                places.setdefault(int(self.owner[n]), []).append(int(self.place[n]))
        out = []
        for owner, where in places.items():
            item_id, item = self.items[owner]
            most = np.zeros(len(item), bool)
            for p in where:
                most[p : p + SEED] = True
            if most.mean() < threshold:
                continue
            tiles = tile(doc, item)
            share = sum(t[0] for t in tiles) / len(item)
            if share >= threshold:
                out.append((item_id, share, len(tiles)))
        return out


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    threshold: float = COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of every document and item at or above the threshold.

    Items of fewer than 5 words cannot be told from ordinary language and match nothing; nor do null
    texts or null ids of items. Rows that repeat an item give one row each document.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_column).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    items = stored(items.where("item_id is not null and text is not null").distinct(), "items")
    count = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = ceil(count / BLOCK_WORDS)
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    # No rows, and no RDD of Python rows, for which every executor would start a second set of Python workers.
    none = ["bigint(null) AS doc_id", "item_id", "double(null) AS coverage", "bigint(null) AS n_tiles"]
    found = items.where("false").selectExpr(none)
    for block in range(blocks):
        rows = items.where(F.expr(f"pmod(xxhash64(item_id), {blocks}) = {block}")).toArrow()
        pairs = zip(rows.column(0).to_pylist(), words.as_bytes(rows.column(1).combine_chunks()))
        tokenised = [(i, tokens(t)) for i, t in pairs]
        known = spark.sparkContext.broadcast([(i, t) for i, t in tokenised if len(t) >= SEED])

        def scan(batches, known=known):
            own = Benchmark(known.value)
            for batch in batches:
                out = []
                for doc_id, data in zip(batch.column(0).to_pylist(), words.as_bytes(batch.column(1))):
                    out += [(doc_id, *hit) for hit in own.covered(tokens(data), threshold)]
                columns = zip(*out) if out else [[]] * 4
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                names = ["doc_id", "item_id", "coverage", "n_tiles"]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

        found = found.union(narrow.mapInArrow(scan, found.schema))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_tiles")).alias("m"))
    return best.select("doc_id", "item_id", "m.coverage", "m.n_tiles")


def contamination(docs: DataFrame, benchmark: DataFrame, threshold: float = COVERAGE, **columns: str) -> DataFrame:
    """Per row of `docs`: doc_id, contaminated, coverage of the best item (0 if none), item_ids.

    item_ids lists the items at or above the threshold in order, empty for clean documents. Rows that
    repeat a doc_id share the result of all of them. Null and empty texts are clean, and so is every
    document if the benchmark is empty. Other columns are ignored.
    """
    found = leaks(docs, benchmark, threshold, **columns)
    by_doc = found.groupBy("doc_id").agg(
        F.max("coverage").alias("coverage"), F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    ids = docs.select(F.col(columns.get("id_column", "doc_id")).cast("long").alias("doc_id"))
    out = ids.join(by_doc, "doc_id", "left")
    return out.select(
        "doc_id",
        F.col("coverage").isNotNull().alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **columns: str) -> DataFrame:
    """The rows of `docs` that are not contaminated."""
    found = leaks(docs, benchmark, id_column=id_column, **columns).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(found, F.col(id_column).cast("long") == F.col("__leak"), "left_anti")
