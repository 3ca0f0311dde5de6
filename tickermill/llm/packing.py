"""Packing of token ids into sequences by minimum bin slack.

A document is its token ids followed by an end id. Its runs of `capacity` ids are sequences of their
own; what remains (less than a sequence) is packed. Which documents have a remaining length does not
matter for the choice, so it works on the counts of the lengths 1 to capacity - 1, whatever the
size of the corpus: take the longest remaining length, find by subset sums over the counts (one bitset
of reachable sums per length) the multiset that fills the window closest to capacity, follow the bitsets
back to the count of each length, and use that filling as often as the counts allow. Where no multiset fills the
window, one more length is cut to fill it and its rest goes back to the counts. What is left at the end is
less than a window and goes into sequences of the sizes of its binary digits, so nothing is padded.

The fillings are intervals of ranks within each length. Each document finds its places by joining
them with the rank that it got where it was tokenised, so only counts ever reach the driver.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickermill.session import stored

CAPACITY = 1024
END_ID = 0
SLICE = 256  # documents whose pieces leave a task together
BROADCAST_PLACES = 100_000  # rows of the table of places, 9 numbers each, that are broadcast at most

# The printable character that stands for each byte in the file, and its word pattern.
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
OTHERS = [b for b in range(256) if b not in PRINTABLE]
CHAR_BYTES = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(OTHERS)}
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

PLACE = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("kind", "first", "after", "cut", "until", "sequence", "used", "each", "at")]
)


class Encoder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file.

    The faster library encodes by the same ranks; it gives up on huge runs of white space, which the
    tokenizers library then takes over.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        ids = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of the merges")
        ranks = {bytes(CHAR_BYTES[c] for c in token): i for token, i in ids.items() if token not in special}
        self.quick = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> list[int]:
        try:
            return self.quick.encode(text, allowed_special="all")
        except ValueError:
            return _library(self.path).encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    return whole


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def closest_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """Multiset of lengths (length: count, within `counts`) whose sum is closest to `room` from below.

    One integer holds the reachable sums as bits; the bits before each length are kept for the way back.
    """
    every = (1 << (room + 1)) - 1
    reached, before = 1, []
    for length in sorted((x for x in counts if 0 < x <= room and counts[x] > 0), reverse=True):
        before.append((length, reached))
        left, step = min(counts[length], room // length), 1
        while left:  # count 1, 2, 4, ... and the rest, which add up to any number of them
            step = min(step, left)
            reached |= reached << (length * step) & every
            left, step = left - step, 2 * step
        if reached >> room:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, bits in reversed(before):
        number = 0
        while not bits >> total & 1:
            total -= length
            number += 1
        if number:
            chosen[length] = number
    return chosen


class _Remaining:
    """Counts per length, and which ranks and cuts of which kind of piece they stand for."""

    def __init__(self, counts: dict[int, int]):
        self.count = {length: n for length, n in counts.items() if n}
        self.queue = {length: deque([(length, 0, 0, n)]) for length, n in self.count.items()}

    def total(self) -> int:
        return sum(length * n for length, n in self.count.items())

    def add(self, length: int, kind: int, cut: int, first: int, n: int) -> None:
        self.count[length] = self.count.get(length, 0) + n
        self.queue.setdefault(length, deque()).append((kind, cut, first, n))

    def take(self, length: int, n: int):
        """(kind, cut, first rank, number) of the next `n` pieces of this length."""
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
        queue, out = self.queue[length], []
        while n:
            kind, cut, first, there = queue.popleft()
            if there > n:
                queue.appendleft((kind, cut, first + n, there - n))
            used = min(n, there)
            out.append((kind, cut, first, used))
            n -= used
        return out


def places(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, ...]]:
    """Rows of PLACE for pieces counted by length (at most `capacity`).

    Pieces of length `kind` with ranks from `first` to before `after` put their ids from `cut` to before
    `until` into a sequence: with k = used + rank - first, sequence + k // each at offset at + (k % each) * (until - cut).
    """
    whole = counts.get(capacity, 0)
    out = [(capacity, 0, whole, 0, capacity, 0, 0, 1, 0)] if whole else []
    rest = _Remaining({x: n for x, n in counts.items() if 0 < x < capacity})
    sequence = whole

    def fill(size: int, seed: int) -> None:
        """Windows of one filling of `size` ids around a piece of length `seed`, as many as there can be."""
        nonlocal sequence
        others = dict(rest.count)
        filling = {}
        if seed <= size:
            others[seed] -= 1
            filling = closest_filling(others, size - seed)
            filling[seed] = filling.get(seed, 0) + 1
        gap = size - sum(x * n for x, n in filling.items())
        times = lambda x, more=0: rest.count[x] // (filling.get(x, 0) + more)
        longer = None
        if gap:
            # Whatever is left over is longer than the gap, or it would have been part of the filling.
            longer = max((x for x in rest.count if times(x, 1)), key=lambda x: (times(x, 1), x))
        windows = min([*(times(x) for x in filling), *([times(longer, 1)] if gap else [])])
        if size < capacity:
            windows = 1
        at = 0
        for length, each in sorted(filling.items(), reverse=True):
            used = 0
            for kind, cut, first, n in rest.take(length, each * windows):
                out.append((kind, first, first + n, cut, cut + length, sequence, used, each, at))
                used += n
            at += each * length
        if gap:
            used, halves = 0, rest.take(longer, windows)
            for kind, cut, first, n in halves:
                out.append((kind, first, first + n, cut, cut + gap, sequence, used, 1, at))
                rest.add(longer - gap, kind, cut + gap, first, n)
                used += n
        sequence += windows

    while rest.total() >= capacity:
        fill(capacity, max(rest.count))
    left = rest.total()
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            fill(1 << bit, max((x for x in rest.count if x <= 1 << bit), default=capacity))
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, keep_ids: bool, id_column: str, text_column: str) -> DataFrame:
    """Tokenised documents, cut at multiples of `capacity`; a written table.

    `part` and `rank` number the pieces of each length within the task that made them. `ids` holds
    the ids as little-endian unsigned 32-bit integers, of whole sequences only with `keep_ids`.
    """
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "part", "rank", "ids"]

    def cut(batches):
        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                some, rows, owner = batch.slice(begin, SLICE), [], []
                for k, text in enumerate(some.column(1).to_pylist()):
                    ids = np.array([*own.encode(text or ""), end_id], "<u4")
                    for start in range(0, len(ids), capacity):
                        code = ids[start : start + capacity].tobytes()
                        length = len(code) // 4
                        kept = code if keep_ids or length < capacity else None
                        rows.append((start, length, len(ids), zlib.crc32(code), part, int(made[length]), kept))
                        made[length] += 1
                        owner.append(k)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 6 + [pa.binary()])]
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(owner)), *columns], names)

    own = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kinds = [own.schema["doc_id"].dataType, *[T.LongType()] * 6, T.BinaryType()]
    return stored(own.mapInArrow(cut, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])), "pieces")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    keep_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with `keep_ids` also ids.

    start is the number of the document's ids before the piece, ids_crc32 the checksum of its ids as
    little-endian unsigned 32-bit integers, doc_tokens the document's ids with the end id. Offsets in a
    sequence are gapless from 0. Every sequence is full or, at the very end, as long as a power of two.

    A null text counts as empty and gives the end id alone; repeated rows and null ids are documents of
    their own; a document of any length is cut; other columns are ignored; no rows give no rows.
    `capacity` is a power of two.
    """
    spark = docs.sparkSession
    made = pieces(docs, tokenizer, capacity, end_id, keep_ids, id_column, text_column)
    lower = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task and length that occurs there.
    tasks = stored(
        made.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn("below", F.coalesce(F.sum("n").over(lower), F.lit(0))),
        "lengths",
    )
    counts = {row.length: row.n for row in tasks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = made.drop("ids").join(tasks.drop("n"), ["length", "part"]).withColumn("place", F.col("below") + F.col("rank"))
    rows = places(counts, capacity)

    def placed(chosen: list[tuple[int, ...]]) -> DataFrame:
        there = spark.createDataFrame(chosen, PLACE)
        there = F.broadcast(there) if len(chosen) <= BROADCAST_PLACES else there
        joined = ranked.join(there, F.expr("length = kind and place >= first and place < after"))
        nth = F.expr("used + place - first")
        return joined.withColumns(
            {
                "sequence_id": F.expr("sequence + (used + place - first) div each"),
                "offset": F.col("at") + nth % F.col("each") * (F.col("until") - F.col("cut")),
            }
        )

    final = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    whole = [row for row in rows if row[4] - row[3] == row[0]]
    cut = placed(rows if keep_ids else [row for row in rows if row[4] - row[3] != row[0]]).join(
        made.select("part", "rank", "length", "ids"), ["part", "rank", "length"]
    )
    cut = cut.withColumns(
        {
            "ids": F.expr("substring(ids, int(1 + 4 * cut), int(4 * (until - cut)))"),
            "start": F.col("start") + F.col("cut"),
            "length": F.col("until") - F.col("cut"),
        }
    ).withColumn("ids_crc32", F.crc32("ids"))
    if keep_ids:
        return cut.select(*final, "ids")
    return placed(whole).select(*final).unionByName(cut.select(*final))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, doc_ids, ids): the packed sequences themselves, from `pack` with `keep_ids`.

    ids are the ids of all pieces in order, as little-endian unsigned 32-bit integers; doc_ids the
    document of each piece. A sequence holds `capacity` ids at most, so no group is large.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("inside")
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside).select(
        "sequence_id",
        "length",
        F.col("inside.doc_id").alias("doc_ids"),
        F.expr("aggregate(inside.ids, binary(''), (x, y) -> concat(x, y))").alias("ids"),
    )
