"""Near-duplicate embeddings: int8 tile products with error bounds, exact recomputation of what they leave open.

Every vector becomes a unit vector u, quantised once as u = s q + e with q in int8 and a known error |e|. For
two vectors, u.v differs from s_u s_v q_u.q_v by at most |e_u| |v| + |s_u q_u| |e_v|, so a pair whose
approximate product plus this bound stays below the threshold cannot link.

Equal vectors are one class. The classes are dealt into blocks of about BLOCK; a task multiplies two
blocks in strips. Codes, scales and errors alone travel to all tiles, a byte a component; what
comes back are the vectors of a tile that have an open pair there. Only these are sent to the tile once
more in double precision, where their open pairs are computed exactly. That gives, for every class, the number of
links it has there and the smallest id that the tile's links reach: rows grow with the vectors of a tile, never
with its pairs. The work is quadratic in the number of different vectors, as every pair has to be bounded.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm.components import components
from tickermill.llm.runs import by_run, trees
from tickermill.session import stored

THRESHOLD, BLOCK, STRIP = 0.95, 4096, 1024
ROUNDING = 1e-9  # above the rounding of a double product, far below any bound


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, |e|) of unit vectors: u = s q + e, q in int8."""
    scale = np.maximum(np.abs(unit).max(axis=1) / 127, 1e-300)
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - scale[:, None] * q, axis=1)


def open_pairs(a: tuple, b: tuple, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two quantised blocks whose product may reach the threshold.

    Columns of like scale are taken together: one comparison with a limit for each row, made of the strip's
    largest scale and error, leaves few pairs, and those are held against their own bound.
    """
    (qa, sa, ea), (qb, sb, eb) = a, b
    # Sums of int8 products are whole numbers below 2^24 here, so single precision holds them exactly.
    wide = np.float32 if qa.shape[1] <= 1024 else np.float64
    left, columns = qa.astype(wide), np.argsort(sb, kind="stable")
    found = [np.zeros((2, 0), np.int64)]
    for start in range(0, len(columns), STRIP):
        strip = columns[start : start + STRIP]
        product = left @ qb[strip].astype(wide).T
        need = threshold - ea - (1 + ea) * eb[strip].max() - ROUNDING
        # One less, so that rounding hides no open pair; without a positive limit all pairs stay.
        limit = np.where(need > 0, need / (sa * sb[strip].max()) - 1, -np.inf)
        x, y = np.nonzero(product >= limit.astype(wide)[:, None])
        near = product[x, y].astype(np.float64) * sa[x] * sb[strip[y]]
        keep = near + ea[x] + (1 + ea[x]) * eb[strip[y]] + ROUNDING >= threshold
        found.append(np.stack([x[keep], strip[y[keep]]]))
    return tuple(np.concatenate(found, axis=1))


def _scaled(vectors) -> np.ndarray:
    """Vectors by a power of two, which leaves every cosine as it is and keeps squares in the range of doubles."""
    raw = np.stack([np.asarray(v, np.float64) for v in vectors])
    return np.ldexp(raw, -np.frexp(np.abs(raw).max(axis=1))[1][:, None])


def _code(batches):
    """Codes of each class, quantised where it lies."""
    for rows in batches:
        for _, part in rows.groupby("width"):
            raw = _scaled(part.vector)
            q, s, e = quantise(raw / np.linalg.norm(raw, axis=1, keepdims=True))
            codes = {"code": [row.tobytes() for row in q], "scale": s, "error": e}
            yield part[["width", "n", "own", "cls"]].assign(**codes)


def _open(threshold: float):
    """Of a tile of codes, the vectors that have an open pair in it."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        q = np.frombuffer(b"".join(rows.code), np.int8).reshape(len(rows), -1)
        s, e, own = (rows[c].to_numpy() for c in ("scale", "error", "own"))
        i, j = rows.i.iat[0], rows.j.iat[0]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        found = np.zeros(len(rows), bool)
        for start in range(0, len(left), STRIP):
            strip = left[start : start + STRIP]
            x, y = open_pairs((q[strip], s[strip], e[strip]), (q[right], s[right], e[right]), threshold)
            x, y = strip[x], right[y]
            found[x[x != y]] = found[y[x != y]] = True
        return pd.DataFrame({"width": rows.width.iat[0], "i": i, "j": j, "cls": rows.cls.to_numpy()[found]})

    return compare


def _tile(threshold: float):
    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        ids, times = rows.rep.to_numpy(), rows.copies.to_numpy()
        raw = _scaled(rows.vector)
        unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
        own, i, j = (rows[c].to_numpy() for c in ("own", "i", "j"))
        left, right = np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])
        links = np.zeros(len(ids), np.int64)
        same_block = i[0] == j[0]
        q, s, e = quantise(unit)
        joined = [np.zeros((0, 2), np.int64)]
        for start in range(0, len(left), STRIP):
            strip = left[start : start + STRIP]
            x, y = open_pairs((q[strip], s[strip], e[strip]), (q[right], s[right], e[right]), threshold)
            x, y = strip[x], right[y]
            if same_block:
                x, y = x[x < y], y[x < y]
            for k in range(0, len(x), 1 << 16):
                p, r = x[k : k + (1 << 16)], y[k : k + (1 << 16)]
                cosine = np.einsum("ij,ij->i", raw[p], raw[r]) / (np.linalg.norm(raw[p], axis=1) * np.linalg.norm(raw[r], axis=1))
                p, r = p[cosine >= threshold], r[cosine >= threshold]
                np.add.at(links, p, times[r])
                np.add.at(links, r, times[p])
                joined.append(trees(np.stack([ids[p], ids[r]], axis=1)))
        tree = trees(np.concatenate(joined))
        least = dict(zip(tree[:, 1], tree[:, 0]))
        has = np.flatnonzero(links)
        out = {"cls": rows.cls.to_numpy()[has], "rep": ids[has], "links": links[has]}
        return pd.DataFrame({**out, "least": [least.get(k, k) for k in ids[has]]})

    return compare


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    n_links counts the other rows with a cosine of at least `threshold` (double precision);
    component_id is the smallest vec_id that links reach. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, nor do vectors of different lengths link with
    each other; null ids link with nothing. Huge and tiny components are scaled before they are squared. Repeated rows are vectors of their own with one id. Other
    columns are ignored. An empty table gives an empty result.
    """
    own = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    usable = F.expr(
        "vec_id is not null and vector is not null and size(vector) > 0"
        " and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(vector, x -> x != 0)"
    )
    # Negative zero and zero are one value; the key stands for the vector in shuffles.
    plain = F.expr("transform(vector, x -> if(x = 0, 0D, x))")
    keyed = own.withColumn("vector", F.when(usable, plain)).withColumn(
        "key", F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256)
    )
    keyed = stored(keyed.withColumn("key", F.when(F.col("vector").isNotNull(), F.col("key"))), "keyed")
    classes = stored(
        keyed.where("vector is not null")
        .groupBy("key")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        # Written once, so the numbers stay; an id that is repeated with another vector stands for two classes.
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    lengths = classes.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    sized = classes.withColumn("width", F.size("vector")).join(stored(lengths, "widths"), "width")
    blocks = F.ceil(F.col("n") / BLOCK)
    sized = sized.withColumn("own", F.pmod(F.xxhash64("key"), blocks))
    coded = sized.select("width", "n", "own", "cls", "vector").mapInPandas(
        _code, "width int, n long, own long, cls long, code binary, scale double, error double"
    )
    tiles = (
        stored(coded, "codes")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("n", "other")
    )
    order = ["width", "i", "j"]
    opened = tiles.repartition(*order).sortWithinPartitions(*order).mapInPandas(
        by_run(order, _open(threshold), pd.concat), "width int, i long, j long, cls long"
    )
    chosen = sized.select("cls", "own", "rep", "copies", "vector")
    dealt = stored(opened, "open").join(chosen, "cls").select(*order, "own", "cls", "rep", "copies", "vector")
    found = dealt.repartition(*order).sortWithinPartitions(*order).mapInPandas(
        by_run(order, _tile(threshold), pd.concat), "cls long, rep long, links long, least long"
    )
    found = stored(found, "tiles")
    grown = components(found.where("rep != least").select(F.col("least").alias("a"), F.col("rep").alias("b")))
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    resolved = classes.select("key", "cls", "rep", "copies").join(counts, "cls", "left")
    resolved = resolved.join(grown, resolved.rep == grown.id, "left").select(
        "key",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    out = keyed.select("vec_id", "key").join(stored(resolved, "resolved"), "key", "left")
    out = out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
