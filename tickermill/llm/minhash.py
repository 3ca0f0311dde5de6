"""Near-duplicate documents: HyperMinHash sketches, banding, corrected estimates, exact verification.

A document is its set of distinct word 5-grams (one whole-sequence shingle for fewer words), words
being maximal runs without space or 0x09-0x0D, A-Z lower-cased. Two documents link when
100 * |intersection| >= 75 * |union|.

1. Sketch: the shingles fall into 512 buckets by leading hash bits; a bucket keeps its smallest hash
   as 6 bits (leading-zero count, or the pass that filled the bucket) and 10 mantissa bits. Buckets
   that stay empty are filled by further passes with other hash functions, so small sets have
   registers that agree with probability J as well.
2. Documents with equal sets are one class, and one member stands for it from here on.
3. Bands of 6 registers: two sets with J = 0.75 share none of the 85 bands with probability
   (1 - 0.75^6)^85 = 6e-8, and less for higher J. Members of a band are first compared with the band's
   smallest id only; then only members of bands that still hold several components are compared,
   and only across components, in tiles of two blocks of members that emit trees of links. Crowded
   bands that share members are compared once as a crowd. So neither copies nor crowded bands are
   ever expanded into rows of pairs.
4. The share of equal registers, corrected for chance agreement of mantissas, has to reach the
   threshold less 6.5 standard deviations (4e-11 of true links stay below).
5. Surviving pairs are confirmed on the full sets of both texts.
"""

from __future__ import annotations

from math import ceil, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import words
from tickermill.llm.components import components
from tickermill.llm.runs import by_run, trees
from tickermill.session import stored

BUCKET_BITS, PASS_BITS = 9, 13
BUCKETS = 1 << BUCKET_BITS
VALUE_BITS = 64 - BUCKET_BITS - PASS_BITS
MANTISSA_BITS = 10
BAND = 6
TILE, CHUNK, CROWD = 1024, 4096, 64
STAR_REGISTERS = 128
BROADCAST_IDS = 1 << 20
WORDS, THRESHOLD = 5, 75

_SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, registers binary"


def shingles(data: np.ndarray | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text in bytes (null or no words: none)."""
    if data is None:
        return np.zeros(0, np.uint64)
    data = words.LOWER[data]
    hashed = words.hashes(data, *words.spans(data))
    return np.unique(words.rolling(hashed, min(width, len(hashed)))) if len(hashed) else hashed


def registers(values: np.ndarray) -> np.ndarray:
    """The 512 HyperMinHash registers (16 bits each) of a set of shingle hashes."""
    passes = min(ceil(BUCKETS * (log(BUCKETS) + 2) / len(values)), 1 << PASS_BITS)
    seeds = np.arange(1, passes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashed = np.concatenate([values[None, :], words.mix(values[None, :] ^ seeds[:, None])])
    rank = np.arange(passes, dtype=np.uint64)[:, None]
    bucket = hashed >> np.uint64(64 - BUCKET_BITS)
    value = (hashed << np.uint64(BUCKET_BITS)) >> np.uint64(64 - VALUE_BITS)
    key = ((bucket << np.uint64(PASS_BITS) | rank) << np.uint64(VALUE_BITS) | value).ravel()
    key.sort()
    bucket = key >> np.uint64(64 - BUCKET_BITS)
    first = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1])
    least = key[first]
    rank = (least >> np.uint64(VALUE_BITS)) & np.uint64((1 << PASS_BITS) - 1)
    value = (least & np.uint64((1 << VALUE_BITS) - 1)).astype(np.float64)
    fraction, exponent = np.frexp(value)  # value = fraction * 2^exponent, fraction in [0.5, 1)
    zeros = np.minimum(VALUE_BITS - exponent, 31)
    code = np.where(rank == 0, zeros, 31 + np.minimum(rank, 32))
    early = (fraction * 2 - 1) * (1 << MANTISSA_BITS)
    late = value / float(1 << (VALUE_BITS - MANTISSA_BITS))
    mantissa = np.where(rank == 0, np.maximum(early, 0), late).astype(np.int64)
    out = np.full(BUCKETS, 0xFFFF, np.uint16)
    out[bucket[first].astype(np.int64)] = code.astype(np.int64) << MANTISSA_BITS | mantissa
    return out


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, less their chance agreement."""
    chance = 2.0**-MANTISSA_BITS
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def sketches(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Set size, 128-bit set fingerprint and registers (null for the empty set) of every document."""

    def sketch(batches):
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch.column(0).to_pylist(), words.as_bytes(batch.column(1))):
                found = shingles(data)
                again = words.mix(found ^ np.uint64(0x2545F4914F6CDD1D))
                rows.append(
                    (
                        doc_id,
                        len(found),
                        int(found.sum(dtype=np.uint64).astype(np.int64)),
                        int(again.sum(dtype=np.uint64).astype(np.int64)),
                        registers(found).tobytes() if len(found) else None,
                    )
                )
            types = [pa.int64()] * 4 + [pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "registers"])
        words.release_memory()

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(sketch, _SKETCH)


def _bands(classes: DataFrame) -> DataFrame:
    count = BUCKETS // BAND
    keys = F.expr(
        f"transform(sequence(0, {count - 1}), i -> xxhash64(i, substring(registers, i * {2 * BAND} + 1, {2 * BAND})))"
    )
    return classes.select("rep", F.explode(keys).alias("key"))


def _slack(threshold: int, count: int) -> float:
    """6.5 standard deviations of the estimate from `count` registers at the threshold."""
    return 6.5 * sqrt(threshold / 100 * (1 - threshold / 100) / count)


def _having(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `table` whose rep is among `ids`; these go to the rows if they are few (8 MB at most)."""
    ids = stored(ids.distinct(), "ids")
    few = ids.count() <= BROADCAST_IDS
    return table.join(F.broadcast(ids) if few else ids, "rep", "left_semi")


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) of representatives that link: estimated first, then counted on both texts."""
    least = threshold / 100 - _slack(threshold, STAR_REGISTERS)

    @F.pandas_udf("boolean")
    def likely(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=bool)
        x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, STAR_REGISTERS) for s in (a, b))
        return pd.Series(estimate(x, y) >= least)

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = (shingles(np.frombuffer(s.encode(), np.uint8)) for s in (x, y))
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= threshold * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    def attach(frame, other):
        for side in ("a", "b"):
            own = other.select(F.col("rep").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in other.columns if c != "rep"])
            frame = frame.join(own, side)
        return frame

    # The first registers are enough to drop nearly all pairs that bands brought together by chance.
    head = classes.select("rep", "n_shingles", F.expr(f"substring(registers, 1, {2 * STAR_REGISTERS})").alias("head"))
    pairs = stored(pairs, "pairs")
    sized = attach(pairs, head)
    # The smaller set has to hold at least the threshold's share of the larger one.
    fits = F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest("n_shingles_a", "n_shingles_b") * threshold
    kept = stored(sized.where(fits).where(likely("head_a", "head_b")).select("a", "b"), "kept")
    own = _having(texts, kept.select(F.explode(F.array("a", "b")).alias("rep")))
    return stored(attach(kept, own).where(linked("text_a", "text_b")).select("a", "b").distinct(), "linked")


def _groups(apart: DataFrame, mixed: DataFrame) -> DataFrame:
    """Members (grp, rep, component) that are to be compared, for bands (key, a, rep, component, n).

    Bands of more than CROWD members that share members form a crowd. If comparing a crowd as a whole takes
    fewer pairs than comparing its bands one by one, its members are listed once, and bands that lie within
    it are left out; all other bands are groups of their own.
    """
    crowded = apart.where(F.col("n") > CROWD).select("a", "rep", "component")
    crowds = components(crowded.select("a", F.col("rep").alias("b")))
    named = crowded.select("rep", "component").distinct().join(crowds, F.col("rep") == F.col("id"), "left")
    named = stored(named.select("rep", "component", F.coalesce("component_id", "rep").alias("crowd")), "named")
    bands = mixed.where(F.col("n") > CROWD).join(crowds, F.col("a") == F.col("id"), "left")
    bands = bands.groupBy(F.coalesce("component_id", "a").alias("crowd")).agg(F.sum(F.col("n") * F.col("n")).alias("cost"))
    cheaper = named.groupBy("crowd").agg(F.count("*").alias("n")).join(bands, "crowd").where("n * n <= cost")
    whole = stored(named.join(cheaper.select("crowd"), "crowd"), "crowds")

    placed = apart.join(whole.select("rep", "crowd").distinct(), "rep", "left").groupBy("key", "n")
    placed = placed.agg(F.count("crowd").alias("inside"), F.min("crowd").alias("least"), F.max("crowd").alias("most"))
    covered = stored(placed.where("inside = n and least = most").select("key"), "covered")
    rest = apart.join(covered, "key", "left_anti").select(F.col("key").alias("grp"), "rep", "component")
    return whole.select(F.xxhash64(F.lit(-1), "crowd").alias("grp"), "rep", "component").union(rest)


def _tiles(members: DataFrame, values: DataFrame, compare) -> DataFrame:
    """Links across components found by `compare` among the members (grp, rep, component) of every group.

    A group of any size is cut into blocks of about TILE members; a task holds two blocks at a time with their
    values, and only links that join its members into trees leave it. The largest component of a group has
    blocks of its own, which meet the blocks of the others but not each other.
    """
    members = stored(members, "members")
    sizes = members.groupBy("grp", "component").agg(F.count("*").alias("n")).groupBy("grp")
    sizes = sizes.agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"))
    first = F.when(F.col("n") <= TILE, F.lit(0).cast("long")).otherwise(F.ceil(F.col("top.n") / TILE))
    others = F.when(F.col("n") <= TILE, F.lit(1).cast("long")).otherwise(F.ceil((F.col("n") - F.col("top.n")) / TILE))
    sizes = sizes.where("parts > 1").select(
        "grp", F.col("top.component").alias("major"), first.alias("first"), (first + others).alias("blocks")
    )
    own = F.expr(
        "if(first > 0 and component = major, pmod(xxhash64(rep), greatest(first, 1L)),"
        " first + pmod(xxhash64(rep), blocks - first))"
    )
    chosen = stored(members.join(stored(sizes, "sizes"), "grp").withColumn("own", own).drop("major"), "chosen")
    dealt = (
        chosen.withColumn("other", F.explode(F.expr("sequence(if(own < first, first, 0L), blocks - 1)")))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "first", "blocks")
        .join(_having(values, chosen.select("rep")), "rep")
    )
    order = ["grp", "i", "j"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInPandas(by_run(order, compare, _merged), "a long, b long")


def _merged(found: list[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame(trees(np.concatenate(found)), columns=["a", "b"])


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the tile's two blocks, and which pairs of them stand in different components."""
    own, i, j, part = (rows[c].to_numpy() for c in ("own", "i", "j", "component"))
    left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
    return left, right, part[left][:, None] != part[right][None, :]


def _joined(rows: pd.DataFrame, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> np.ndarray:
    ids, (x, y) = rows.rep.to_numpy(), np.nonzero(linked)
    return trees(np.stack([ids[left[x]], ids[right[y]]], axis=1))


def _likely_links(threshold: int):
    least = threshold / 100 - _slack(threshold, BUCKETS)

    def compare(rows: pd.DataFrame) -> np.ndarray:
        left, right, maybe = _sides(rows)
        size = rows.n_shingles.to_numpy()
        a, b = size[left], size[right]
        maybe &= np.minimum.outer(a, b) * 100 >= np.maximum.outer(a, b) * threshold
        regs = np.frombuffer(b"".join(rows.registers), np.uint16).reshape(-1, BUCKETS)
        facing = regs[right]
        for k in np.flatnonzero(maybe.any(axis=1)):
            maybe[k] &= estimate(regs[left[k]], facing) >= least
        return _joined(rows, left, right, maybe)

    return compare


def _exact_links(threshold: int):
    def compare(rows: pd.DataFrame) -> np.ndarray:
        left, right, apart = _sides(rows)
        sets = [shingles(np.frombuffer(t.encode(), np.uint8)) for t in rows.text]
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[column] > 1
        owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
        both = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, int((times > 1).sum()), CHUNK):
            here = (column >= start) & (column < start + CHUNK)
            has = np.zeros((len(sets), CHUNK), np.float32)
            has[owner[here], column[here] - start] = 1
            both += has[left] @ has[right].T
        union = size[left][:, None] + size[right][None, :] - both
        return _joined(rows, left, right, apart & (100 * both >= threshold * union) & (size[left][:, None] > 0))

    return compare


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that links reach. Documents without words (null, empty or
    blank text) link with nothing and keep their own id; so do null ids. Rows that repeat an id with
    the same text get equal results; if their texts differ, the id has the links of all its rows.
    Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    sketch = stored(sketches(docs, id_column, text_column), "sketches")
    members = sketch.select("doc_id", "n_shingles", "set_a", "set_b")
    classes = stored(
        sketch.where("n_shingles > 0 and doc_id is not null")
        .groupBy("n_shingles", "set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.min_by("registers", "doc_id").alias("registers")),
        "classes",
    )
    texts = docs.select(F.col(id_column).cast("long").alias("rep"), F.col(text_column).cast("string").alias("text"))
    texts = texts.where("rep is not null and text is not null")

    keys = _bands(classes)
    buckets = stored(
        keys.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a"),
        "buckets",
    )
    shared = stored(keys.join(buckets, "key"), "shared")
    stars = shared.where("rep != a").select("a", F.col("rep").alias("b")).distinct()
    links = _verified(stars, classes, texts, threshold)

    # What the stars left apart: bands with several components, compared across components. The centre
    # of a star was held against its whole band, so a band counts without it.
    found = components(links)
    own = F.coalesce("component_id", "rep").alias("component")
    others = shared.where("rep != a").join(found, F.col("rep") == F.col("id"), "left").select("key", "a", "rep", own)
    others = stored(others, "others")
    mixed = others.groupBy("key", "a").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("n")
    )
    mixed = stored(mixed.where("least != most").select("key", "a", "n"), "mixed")
    apart = stored(others.join(mixed.select("key", "n"), "key"), "apart")
    sketched = classes.select("rep", "n_shingles", "registers")
    likely = stored(_tiles(_groups(apart, mixed), sketched, _likely_links(threshold)), "likely")
    clusters = components(likely).select(F.col("id").alias("rep"), F.col("component_id").alias("grp"))
    clusters = clusters.union(clusters.select("grp", "grp")).distinct()
    clusters = clusters.join(found, F.col("rep") == F.col("id"), "left").select("grp", "rep", own)
    links = links.union(_tiles(clusters, texts, _exact_links(threshold)))

    found = components(links)
    reps = classes.select("n_shingles", "set_a", "set_b", "rep")
    reps = stored(
        reps.join(found, reps.rep == found.id, "left").select(
            "n_shingles", "set_a", "set_b", F.coalesce("component_id", "rep").alias("component")
        ),
        "resolved",
    )
    out = members.join(reps, ["n_shingles", "set_a", "set_b"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose document is the first of its group (or stands alone)."""
    dropped = near_duplicates(docs, id_column, text_column).where("not kept").select(F.col("doc_id").alias("__gone"))
    return docs.join(dropped.distinct(), F.col(id_column).cast("long") == F.col("__gone"), "left_anti")
