"""Language identification by the nearest of several centroids per language.

A text is a vector of 4096 hashed n-grams (1 to 3 characters, lower case, letters with their word
borders): log counts times inverse document frequency, normalised. The document frequencies come
from all documents that may be learned from, and the vectors of all of them are clustered by cosine into up
to CENTROIDS centroids of each language. The language of the nearest centroid by cosine
wins; a text whose similarity to it is below the limit for texts of its length is rejected. The limits come
from pieces and whole texts of the same documents, each compared with centroids without its own document: what
hardly any text of a language falls below, unless even other languages hardly reach it.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import training, words
from tickermill.session import stored, temporary_tables

BUCKET_BITS, GRAMS, CENTROIDS = 12, (1, 2, 3), 3
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
# A limit lies where this share of the own-language similarities is below it, or that of other languages.
OWN_BELOW, OTHER_BELOW = 0.002, 0.99
# Letters of the pieces that limits are learned from; a text's class is the power of two of its n-grams.
PIECES, CLASSES = tuple(1 << k for k in range(4, 11)), 12
# Letters in the middle of a text that hold its pieces, texts whose n-grams (and whose pieces') are in memory at a time,
# and the units in which weights are summed and similarities counted.
MIDDLE, SLICE, PIECE_SLICE, SCALE, STEPS = max(PIECES), 1000, 100, 1 << 24, 10_000


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def buckets(text: str | None) -> np.ndarray | None:
    """Bucket of every n-gram of a text; None if it has no letter."""
    found = piece_buckets([text])[1] if text else ()
    return found if len(found) else None


def piece_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of every n-gram of some texts; texts without a letter have none."""
    # One border after each text is the last one's and the next one's: no n-gram crosses it.
    lower = [text.lower() + " " for text in texts]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    own = np.repeat(np.arange(len(texts)), np.array([len(text) for text in lower], np.int64))
    letter = letters()[codes]
    # A run of other characters counts as one border.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    own = np.concatenate([[0], own[keep], [0]])
    codes = np.where(letter, codes, np.uint32(32))[keep].astype(np.uint64) + np.uint64(1)
    codes = np.concatenate([np.array([33], np.uint64), codes, np.array([33], np.uint64)])
    border = np.concatenate([[0], np.cumsum(codes == 33)])
    numbers, found = [], []
    for size in GRAMS:
        rolled = words.rolling(codes, size)
        start = np.arange(len(rolled))
        inside = border[start + size] - border[start] < size
        if size > 2:
            inside &= border[start + size - 1] == border[start + 1]
        start = start[inside]
        numbers.append(own[start + (codes[start] == 33)])  # a border belongs to the text of the letter after it
        found.append(words.mix(rolled[inside] + np.uint64(size)))
    return np.concatenate(numbers), (np.concatenate(found) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def weighted(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The normalised vector of a text's buckets."""
    out = (np.log1p(np.bincount(found, minlength=BUCKETS)) * idf).astype(np.float32)
    size = np.linalg.norm(out)
    return out / size if size else out


def length_class(found: np.ndarray) -> int:
    return min(len(found).bit_length() - 1, CLASSES - 1)


@dataclass
class Model:
    """`limit` is the least similarity of an accepted text, by the class of its length."""

    idf: np.ndarray
    centroids: np.ndarray
    language: list[str]
    limit: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, cosine, rejected) of a text."""
        found = buckets(text)
        if found is None or not len(self.language):
            return UNKNOWN, 0.0, True
        close = self.centroids @ weighted(found, self.idf)
        best = int(close.argmax())
        return self.language[best], float(np.clip(close[best], 0, 1)), bool(close[best] < self.limit[length_class(found)])


@dataclass
class Clusters:
    """Centroids of every language in its slots, as wide as there are buckets; `used` tells which slots have one."""

    idf: np.ndarray
    languages: list[str]
    centres: np.ndarray
    used: np.ndarray

    def slices(self, batch: pa.RecordBatch, texts: int = SLICE):
        """(number of the language by text; row, bucket and normalised weight by n-gram; first n-gram of a text;
        place in the batch), for few texts at a time."""
        number = {lang: k for k, lang in enumerate(self.languages)}
        for at in range(0, batch.num_rows, texts):
            part = batch.slice(at, texts)
            found = part.column("buckets").to_pylist()
            bucket = np.frombuffer(b"".join(found), np.uint16).astype(np.int64)
            count = np.frombuffer(b"".join(part.column("counts").to_pylist()), np.uint32)
            size = np.array([len(x) // 2 for x in found])
            start, row = np.cumsum(size) - size, np.repeat(np.arange(len(size)), size)
            weight = np.log1p(count) * self.idf[bucket]
            weight /= np.sqrt(np.add.reduceat(weight**2, start))[row]
            yield np.array([number[lang] for lang in part.column("lang").to_pylist()]), row, bucket, weight, start, at

    def close(self, lang: np.ndarray, row: np.ndarray, bucket: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Similarity of each text to the centroids of its own language; below all others where there is none."""
        of = lang[row]
        found = [np.add.reduceat(weight * self.centres[of, k, bucket], start) for k in range(self.centres.shape[1])]
        return np.where(self.used[lang], np.stack(found, axis=1), -2.0)

    def with_sums(self, sums: np.ndarray) -> Clusters:
        """The centroids of the members' sums; slots without members are left out."""
        size = np.linalg.norm(sums.astype(np.float64), axis=2, keepdims=True)
        return Clusters(self.idf, self.languages, sums / np.maximum(size, 1e-12), size[:, :, 0] > 0)


def _gram_rows(known: DataFrame) -> DataFrame:
    """Buckets and their counts of every text, its middle and its length, written once; empty for letterless texts."""

    def grams(batches):
        for batch in batches:
            found = [buckets(text) for text in batch.column("text").to_pylist()]
            at = [np.unique(x, return_counts=True) if x is not None else (np.zeros(0), np.zeros(0)) for x in found]
            texts = batch.column("text").to_pylist()
            middle = [t[max(0, (len(t) - MIDDLE) // 2) :][:MIDDLE] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("lang"), batch.column("hash"),
                    pa.array([x.astype(np.uint16).tobytes() for x, _ in at], pa.binary()),
                    pa.array([n.astype(np.uint32).tobytes() for _, n in at], pa.binary()),
                    pa.array(middle, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["doc_id", "lang", "hash", "buckets", "counts", "middle", "letters"],
            )

    layout = "doc_id long, lang string, hash long, buckets binary, counts binary, middle string, letters long"
    return stored(known.withColumn("hash", F.xxhash64("text")).mapInArrow(grams, layout), "grams")


def _one_per_id(rows: DataFrame) -> DataFrame:
    """Of a repeated id of a language the text whose hash is smallest."""
    keys = ["doc_id", "lang"]
    counted = rows.groupBy(*keys).agg(F.min("hash").alias("_least"), F.count("*").alias("_n"))
    repeated = stored(counted.where("_n > 1").drop("_n"), "repeated")
    if repeated.isEmpty():
        return rows
    first = rows.join(repeated, keys).where("hash = _least").drop("_least").dropDuplicates(keys)
    return stored(rows.join(repeated, keys, "left_anti").unionByName(first.select(*rows.columns)), "learned")


def _sums(rows: DataFrame, clusters: Clusters) -> np.ndarray:
    """Sum of the members of every centroid, in whole units of SCALE, so that no order of adding changes it."""
    spread, shape = rows.sparkSession.sparkContext.broadcast(clusters), clusters.centres.shape

    def add(batches):
        own, total = spread.value, np.zeros(int(np.prod(shape)), np.int64)
        for batch in batches:
            for lang, row, bucket, weight, start, _ in own.slices(batch):
                slot = lang * shape[1] + own.close(lang, row, bucket, weight, start).argmax(axis=1)
                np.add.at(total, slot[row] * BUCKETS + bucket, np.rint(weight * SCALE).astype(np.int64))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = rows.mapInArrow(add, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(int(np.prod(shape)), np.int64)  # as large as the model
    total[found["at"].to_numpy(np.int64)] = found.n.to_numpy(np.int64)
    return total.reshape(shape)


def _extreme(rows: DataFrame, clusters: Clusters, sign: int) -> np.ndarray:
    """Vector of each language's document with the least sign x similarity to its nearest centroid, smallest id first."""
    spread = rows.sparkSession.sparkContext.broadcast(clusters)

    def least(batches):
        own, best = spread.value, {}
        for batch in batches:
            for lang, row, bucket, weight, start, at in own.slices(batch):
                score = sign * own.close(lang, row, bucket, weight, start).max(axis=1)
                ids = batch.column("doc_id").slice(at, len(lang)).to_numpy()
                for k in np.unique(lang):
                    mine = np.flatnonzero(lang == k)
                    first = mine[np.lexsort((ids[mine], score[mine]))[0]]
                    if int(k) not in best or (score[first], ids[first]) < best[int(k)][:2]:
                        here = row == first
                        vector = bucket[here].astype(np.uint16).tobytes(), weight[here].tobytes()
                        best[int(k)] = (float(score[first]), int(ids[first]), *vector)
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("lang", "score", "doc_id", "buckets", "weights"), (k, *x))) for k, x in best.items()],
            pa.schema([("lang", pa.int64()), ("score", pa.float64()), ("doc_id", pa.int64()), ("buckets", pa.binary()), ("weights", pa.binary())]),
        )

    found = rows.mapInArrow(least, "lang long, score double, doc_id long, buckets binary, weights binary")
    one = F.min(F.struct("score", "doc_id", "buckets", "weights")).alias("one")
    out = np.zeros((len(clusters.languages), BUCKETS))
    for r in found.groupBy("lang").agg(one).select("lang", "one.buckets", "one.weights").collect():
        out[r.lang, np.frombuffer(r.buckets, np.uint16)] = np.frombuffer(r.weights)
    return out


def cluster(rows: DataFrame, idf: np.ndarray, languages: list[str], rounds: int = 12) -> tuple[Clusters, np.ndarray]:
    """Spherical k-means over all rows of each language from far-apart starts, and the sums of the members.

    A round reads the stored n-grams once; what comes to the driver is as large as the model.
    """
    shape = (len(languages), CENTROIDS, BUCKETS)
    clusters = Clusters(idf, languages, np.zeros(shape), np.arange(CENTROIDS)[None, :].repeat(len(languages), 0) == 0)
    clusters.centres[:, 0] = clusters.with_sums(_sums(rows, clusters)).centres[:, 0]
    clusters.centres[:, 0] = _extreme(rows, clusters, -1)  # the document nearest to the mean
    for k in range(1, CENTROIDS):
        clusters.centres[:, k] = _extreme(rows, clusters, 1)
        clusters.used[:, k] = True
    sums = _sums(rows, clusters)
    for _ in range(rounds):
        clusters = clusters.with_sums(sums)
        before, sums = sums, _sums(rows, clusters)
        if (before == sums).all():
            break
    return clusters, sums


def fit(docs: DataFrame, folds: int = 3, held_out: int = 1, lang_column: str = "lang") -> Model:
    """The model learned from text and non-null language of all documents outside the held-out fold.

    Of a repeated id one text is clustered. The n-grams of the texts are written once and read in every round.
    """
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    ).where((training.fold(F.col("doc_id"), folds) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    with temporary_tables(docs.sparkSession):
        return _fit(_gram_rows(known))


def _fit(grams: DataFrame) -> Model:
    def frequencies(batches):
        total = np.zeros(BUCKETS + 1, np.int64)  # the last one counts documents
        for batch in batches:
            for found in batch.column(0).to_pylist():
                total[np.frombuffer(found, np.uint16)] += 1
                total[-1] += 1
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    lettered = grams.where("length(buckets) > 0")
    counts = lettered.select("buckets").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS + 1)
    for bucket, n in counts.collect():  # BUCKETS + 1 rows at most
        total[bucket] = n
    idf = np.log((1 + total[-1]) / (1 + total[:-1])) + 1
    rows = _one_per_id(grams).where("length(buckets) > 0")
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())  # as many as the model has
    if not languages:
        return Model(idf, np.zeros((0, BUCKETS), np.float32), [], np.zeros(CLASSES))
    clusters, sums = cluster(rows.select("doc_id", "lang", "buckets", "counts"), idf, languages)
    language = [lang for k, lang in enumerate(languages) for _ in range(clusters.used[k].sum())]
    return Model(idf, clusters.centres[clusters.used].astype(np.float32), language, _limits(rows, clusters, sums))


def _limits(rows: DataFrame, clusters: Clusters, sums: np.ndarray) -> np.ndarray:
    """The least similarity of accepted texts by length class; 0 for lengths of which there is no text.

    Similarities count in steps of 1 / STEPS, so that a table of bounded size holds those of all texts.
    """
    spread = rows.sparkSession.sparkContext.broadcast((clusters, sums / SCALE))

    def similarities(batches):
        (own, sums), total = spread.value, np.zeros(CLASSES * 2 * (2 * STEPS + 1), np.int64)
        size = (sums**2).sum(axis=2)
        for batch in batches:
            for part in own.slices(batch, PIECE_SLICE):
                lang, row, bucket, weight, start, at = part
                member = own.close(*part[:5]).argmax(axis=1)
                middles = batch.column("middle").slice(at, len(lang)).to_pylist()
                length = batch.column("letters").slice(at, len(lang)).to_numpy()
                counts = batch.column("counts").slice(at, len(lang)).to_pylist()
                pieces, of = [], []
                for i, n in enumerate(length):
                    for own_length in (x for x in PIECES if x <= n):
                        begin = (n - own_length) // 2 - max(0, (n - MIDDLE) // 2)
                        pieces.append(middles[i][begin : begin + own_length])
                        of.append(i)
                number, found = piece_buckets(pieces)
                seen = np.bincount(number * BUCKETS + found, minlength=len(pieces) * BUCKETS)
                cell = np.flatnonzero(seen)
                # The pieces that have a letter, and after them the whole texts.
                used, first = np.unique(cell // BUCKETS, return_index=True)
                grams = np.concatenate([np.bincount(number, minlength=len(pieces))[used], [np.frombuffer(x, np.uint32).sum() for x in counts]])
                text = np.concatenate([np.array(of, np.int64)[used], np.arange(len(lang))])
                piece = np.log1p(seen[cell]) * own.idf[cell % BUCKETS]
                if len(cell):
                    piece /= np.repeat(np.sqrt(np.add.reduceat(piece**2, first)), np.diff(np.append(first, len(cell))))
                gram, value = np.concatenate([cell % BUCKETS, bucket]), np.concatenate([piece, weight])
                first = np.concatenate([first, start + len(cell)])
                on = np.repeat(text, np.diff(np.append(first, len(gram))))
                like = np.full((len(text), *own.used.shape), -2.0)
                for k, slot in zip(*np.nonzero(own.used)):
                    like[:, k, slot] = np.add.reduceat(value * own.centres[k, slot, gram], first)
                # The own centroid without the own document.
                whole = np.zeros((len(lang), BUCKETS))
                whole[row, bucket] = weight
                inner = np.add.reduceat(weight * sums[lang[row], member[row], bucket], start)
                left = np.sqrt(np.maximum(size[lang, member] - 2 * inner + 1, 0))[text]
                rest = np.add.reduceat(value * (sums[lang[on], member[on], gram] - whole[on, gram]), first)
                like[np.arange(len(text)), lang[text], member[text]] = np.where(left > 1e-3, rest / np.maximum(left, 1e-3), 0)
                mine = np.arange(len(own.languages))[None, :] == lang[text][:, None]
                best = like.max(axis=2)
                others = np.where(mine, -2.0, best).max(axis=1) if len(own.languages) > 1 else np.ones(len(text))
                klass = np.minimum(np.frexp(grams)[1] - 1, CLASSES - 1)  # the class of a text's length
                for kind, x in enumerate((best[mine], others)):
                    step = np.rint(np.clip(x, -1, 1) * STEPS).astype(np.int64) + STEPS
                    np.add.at(total, (klass * 2 + kind) * (2 * STEPS + 1) + step, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = rows.select("lang", "buckets", "counts", "middle", "letters").mapInArrow(similarities, "at long, n long")
    total = np.zeros(CLASSES * 2 * (2 * STEPS + 1), np.int64)
    for at, n in found.groupBy("at").agg(F.sum("n").alias("n")).collect():  # as many rows as there are steps, at most
        total[at] = n
    limit = np.zeros(CLASSES)
    for size, (own, other) in enumerate(total.reshape(CLASSES, 2, -1)):
        if own.sum():
            limit[size] = min(_quantile(own, OWN_BELOW), _quantile(other, OTHER_BELOW))
    return np.maximum(limit, 0)


def _quantile(counts: np.ndarray, share: float) -> float:
    """`np.quantile` of the counted steps."""
    place = share * (counts.sum() - 1)
    low, high = np.searchsorted(np.cumsum(counts), [np.floor(place), np.ceil(place)], side="right")
    return float((low + (high - low) * (place - np.floor(place)) - STEPS) / STEPS)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with lang_pred, score and rejected added, under these names (older ones are replaced).

    Null, empty and letterless texts are `und` and rejected; repeated rows get equal results; texts of any
    length are read whole. A text is predicted once, whatever conditions follow on the result; conditions
    that spare texts the prediction belong to `docs`.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = known.value
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    # A condition on the result would else be moved below it, with a prediction and a Python worker of its own.
    predict = predict.asNondeterministic()
    added = ["lang_pred", "score", "rejected"]
    out = docs.drop(*added).withColumn("__found", predict(F.col("text").cast("string")))
    return out.withColumns({c: F.col("__found")[c] for c in added}).drop("__found")


def predictions(docs: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred, score (cosine to the centroid) and rejected.

    Texts that are null or have no letter are `und` with score 0 and rejected, and so is every text if
    there is nothing to learn from. Repeated rows get equal results; a null doc_id is neither held out
    nor learned from. Of `docs` only doc_id, text and, for learning, lang are read.
    """
    model = fit(docs, folds, held_out)
    found = identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    is_out = F.coalesce(training.fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    return found.select("doc_id", is_out.alias("held_out"), "lang_pred", "score", "rejected")
