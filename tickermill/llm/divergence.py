"""Divergence of the sources of a language by word counts, over run-length columns.

A term is a run of letters (A-Z and every character beyond 0x7F), A-Z lower-cased. A language keeps the
terms that occur in at least `MIN_DOCS` of its documents, V of them; a group is a (lang, source) that occurs, whether
or not it has terms. For a count of a kept term, p = 1 + floor(10^9 (count + 2) / (N + 2V)), with N the
sum of the counts; two such numbers differ by f = floor((p - q)^2 / (p + q)).

The counts of a language are a table of terms by sources. Its rows are sorted by their total and then by
their non-zero counts, so that terms with equal counts come to lie together, and cut into blocks of even
size. In a block the column of each source is encoded as runs of equal counts. A pair of sources is
compared by the borders of both columns' runs: f is computed once for each stretch between borders and
multiplied by its length. Blocks add up, since the order of the terms has no influence on the sum.

All numbers are integers: p is at most 10^9 + 1, so f fits 64 bits, and quotients use exact integers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickermill.session import stored

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
ENTRIES = 1 << 18  # (group, term) counts that a task holds before it passes them on
BLOCK = 1 << 18  # counts of a block, but for its last term's

LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, summed per task.

    `docs` has text, lang and source without nulls. Bytes beyond 0x7F are parts of characters beyond 0x7F,
    so the words of the bytes are those of the text.
    """

    def count(batches):
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for text, *group in zip(batch.column(0).cast(pa.large_binary()), langs, sources):
                words = text.as_py().translate(LETTERS).split()
                if not words:
                    continue
                held = found.get(tuple(group))
                if held is None:
                    held = found[tuple(group)] = Counter(), Counter()
                size -= len(held[1])
                held[0].update(words)
                held[1].update(set(words))
                size += len(held[1])
                if size > ENTRIES:
                    yield from _counted(found)
                    found, size = {}, 0
        yield from _counted(found)

    return docs.select("text", "lang", "source").mapInArrow(
        count, "lang string, source string, term string, n long, docs long"
    )


def _counted(found):
    for (lang, source), (number, docs) in found.items():
        size = len(number)
        columns = [
            pa.array([lang]).take(pa.array(np.zeros(size, np.int32))),
            pa.array([source]).take(pa.array(np.zeros(size, np.int32))),
            pa.array(list(number), pa.binary()).cast(pa.string()),
            pa.array(list(number.values()), pa.int64()),
            pa.array([docs[term] for term in number], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def share(count: str, total: str, kinds: str) -> Column:
    """p of a count, exact for any count that fits 64 bits."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(19,0))) div CAST({total} + 2 * {kinds} AS DECIMAL(20,0))")


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, total, counts) of kept terms; counts has (source, n) of the sources that hold the term."""
    # Each task has summed its own rows, so one shuffle by term serves both aggregations.
    dealt = term_counts(docs).repartition("lang", "term")
    groups = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = groups.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("n").alias("total"),
        F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts"),
    )
    return stored(terms.where(F.col("docs") >= min_docs).drop("docs"), "terms")


def _totals(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, n_group, n_lang, kinds) of every group, groups and languages without kept terms included."""
    groups = docs.select("lang", "source").distinct()
    by_lang = terms.groupBy("lang").agg(F.sum("total").alias("n_lang"), F.count("*").alias("kinds"))
    by_group = (
        terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    )
    joined = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left")
    return stored(joined.na.fill(0, ["n_group", "n_lang", "kinds"]), "groups")


def blocks(terms: DataFrame) -> DataFrame:
    """(lang, task, block, place, source, n): counts dealt out in the order that brings equal columns together."""
    order = ["lang", "total", "counts"]
    dealt = terms.select("term", *order).repartitionByRange(*order, "term").sortWithinPartitions(*order)
    placed = stored(
        dealt.select("lang", "counts", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")), "places"
    )
    before = Window.partitionBy("lang", "task").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    cut = placed.withColumn("above", F.coalesce(F.sum(F.size("counts")).over(before), F.lit(0)))
    return cut.select("lang", "task", F.expr(f"above div {BLOCK} AS block"), "place", F.inline("counts"))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of the runs of equal values."""
    start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return start, values[start]


def _exact_shares(counts: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """p of every run; Python integers, so that no product overflows."""
    return np.array([1 + SCALE * (n + 2) // (total + 2 * kinds) for n in counts.tolist()], np.int64)


def _compare_block(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
    """Sum of f over the terms of one block for each pair of sources, the smaller source first."""
    groups = groups.sort_values("source", ignore_index=True)
    first, size = rows["place"].min(), rows["place"].max() - rows["place"].min() + 1
    held = {source: (own["place"].to_numpy() - first, own["n"].to_numpy()) for source, own in rows.groupby("source")}
    columns = []
    for group in groups.itertuples():
        values = np.zeros(size, np.int64)
        if group.source in held:
            where, n = held[group.source]
            values[where] = n
        start, counts = _runs(values)
        columns.append((start, _exact_shares(counts, int(group.n_group), int(group.kinds))))
    names, out = groups["source"].tolist(), []
    for a, (start, p) in enumerate(columns):
        for b in range(a + 1, len(columns)):
            other, q = columns[b]
            border = np.union1d(start, other)
            x = p[np.searchsorted(start, border, "right") - 1]
            y = q[np.searchsorted(other, border, "right") - 1]
            length = np.diff(border, append=size)
            out.append((names[a], names[b], int(((x - y) ** 2 // (x + y) * length).sum())))
    made = pd.DataFrame(out, columns=["source", "item", "value"])
    made.insert(0, "lang", groups["lang"].iloc[0] if len(groups) else None)
    return made


def pair_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two different sources of a language, both ways."""
    dealt = blocks(terms)
    key = ["lang", "task", "block"]
    inside = dealt.select(*[F.col(c).alias(f"in_{c}") for c in key]).distinct()
    inside = inside.join(groups, F.col("in_lang") == F.col("lang"))
    sums = (
        dealt.groupBy(*key)
        .cogroup(inside.groupBy(*[f"in_{c}" for c in key]))
        .applyInPandas(_compare_block, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    both = sums.select("lang", F.expr("inline(array(struct(source, item, value), struct(item AS source, source AS item, value)))"))
    # The result has a row for each pair; those of languages without kept terms have no block.
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang")
    pairs = pairs.where("source <> item")
    return pairs.join(both, ["lang", "source", "item"], "left").na.fill(0, ["value"])


def term_values(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that are more frequent in a source than in its language."""
    held = terms.select("lang", "term", "total", F.inline("counts")).join(groups, ["lang", "source"])
    shares = held.withColumns({"p": share("n", "n_group", "kinds"), "q": share("total", "n_lang", "kinds")})
    value = F.expr("(p - q) * (p - q) div (p + q)")
    return shares.where("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others, and by which terms.

    Part `pair` has every other source of the language with the sum of f over all kept terms; part `term`
    the `top_terms` terms with the largest f of those that are more frequent than in the whole language. Ranks
    count from 1 by descending value, then by the item's UTF-8 bytes.

    Null text, lang and source count as ''; repeated rows count as often as they occur; texts of any
    length are read whole; a single source of a language has no pairs; other columns are ignored; no rows
    give no rows. Of sources there is one row per pair in the result, so one language's
    list of sources is taken to fit a task.
    """
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    terms = kept_terms(own, min_docs)
    groups = _totals(own, terms)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    parts = [
        pair_values(terms, groups).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)}),
        term_values(terms, groups)
        .withColumns({"part": F.lit("term"), "rank": F.row_number().over(order)})
        .where(F.col("rank") <= top_terms),
    ]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
