"""MinHash, embedding and component operators against brute force."""

import random
import tracemalloc
import re
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from .llm_brute import smallest_reachable

from tickermill.llm import decontamination, embeddings, minhash, words
from tickermill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}


def brute_groups(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    links = [
        (a, b)
        for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    return sets, smallest_reachable(sets, links)


def near_copies(seed, groups=12, members=8):
    """Groups of edited copies around the threshold, short and long, with passages that all share."""
    draw, rows = random.Random(seed), []
    shared = [f"s{k}" for k in range(40)]
    for g in range(groups):
        size = draw.choice([3, 5, 6, 9, 20, 60, 200, 700])
        base = [f"g{g}w{k}" for k in range(size)]
        for _ in range(members):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, size // 35))):
                copy[draw.randrange(size)] = f"e{draw.random()}"
            rows.append(copy + (shared if draw.random() < 0.3 else []))
    draw.shuffle(rows)
    return [(i, " ".join(words).upper() if i % 5 == 0 else " ".join(words), None) for i, words in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_against_brute_force(frame, documents, seed):
    for df in (frame(near_copies(seed)), *([documents] if seed == 1 else [])):
        sets, label = brute_groups({r.doc_id: r.text for r in df.collect()})
        rows = minhash.near_duplicates(df).collect()
        assert len(rows) == len(sets)
        for row in rows:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), label[row.doc_id])
            assert row.kept == (row.doc_id == row.component_id)


def test_near_duplicates_of_odd_rows(odd, empty):
    out = {r.doc_id: r for r in minhash.near_duplicates(odd).collect()}
    assert [out[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert all(out[i].kept for i in (1, 2, 3, 4, 5, 6, 8, 9)) and out[7].component_id == 6
    assert out[None].component_id is None and minhash.near_duplicates(odd).count() == odd.count()
    assert minhash.near_duplicates(empty).collect() == []
    assert minhash.keep_first(odd).columns == odd.columns
    assert minhash.keep_first(odd).count() == odd.count() - 1


def test_estimates_follow_the_similarity():
    draw = np.random.default_rng(3)
    for size in (4, 40, 900):
        for share in (0.3, 0.75, 0.95):
            errors = []
            for _ in range(20):
                both = draw.integers(0, 2**63, int(size * share) or 1).astype(np.uint64)
                rest = draw.integers(0, 2**63, (2, max(0, (size - len(both)) // 2))).astype(np.uint64)
                a, b = (np.unique(np.concatenate([both, r])) for r in rest)
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                errors.append(minhash.estimate(minhash.registers(a), minhash.registers(b)) - true)
            assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.12


def test_a_crowd_that_shares_a_band_is_compared_in_tiles(frame, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    rows = near_copies(9, groups=4, members=40)
    _, label = brute_groups({r[0]: r[1] for r in rows})
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows)).collect()}
    assert out == label


def passage_crowd(n, seed=11):
    """Texts that share a long passage, so that they meet in many bands, but link with nothing; and two that link."""
    draw = random.Random(seed)
    passage = [f"p{k}" for k in range(60)]
    rows = [" ".join(passage + [f"u{draw.random()}" for _ in range(14)]) for _ in range(n)]
    return [(i, text, None) for i, text in enumerate([*rows, rows[n // 2] + " last"])]


def test_a_crowd_that_meets_in_many_bands_is_listed_once(frame, monkeypatch):
    tiles, listed = minhash._tiles, []

    def counted(members, *rest):
        listed.append(members.count())
        return tiles(members, *rest)

    monkeypatch.setattr(minhash, "_tiles", counted)
    monkeypatch.setattr(minhash, "TILE", 50)
    rows = passage_crowd(200)
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows)).collect()}
    assert out == {i: min(i, 100) if i == 200 else i for i in range(201)}
    assert listed[0] <= 2 * len(rows)


@pytest.mark.parametrize("crowd,tile", [(2, 8), (8, 16), (30, 1024)])
def test_crowds_and_bands_of_their_own_lose_no_link(frame, monkeypatch, crowd, tile):
    monkeypatch.setattr(minhash, "CROWD", crowd)
    monkeypatch.setattr(minhash, "TILE", tile)
    rows = near_copies(13, groups=6, members=40)
    rows += [(len(rows) + i, text, lang) for i, text, lang in passage_crowd(60)]
    _, label = brute_groups({r[0]: r[1] for r in rows})
    out = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows)).collect()}
    assert out == label


def test_only_the_smaller_components_of_a_group_meet_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 8)
    parts = [0] * 60 + [100, 101, 102]
    members = spark.createDataFrame([(1, k, p) for k, p in enumerate(parts)], "grp long, rep long, component long")
    values = members.select("rep", F.col("rep").alias("value"))

    def compare(rows):
        left, right, apart = minhash._sides(rows)
        return np.array([[-1 - len(rows), int(apart.sum())]])

    monkeypatch.setattr(minhash, "_merged", lambda found: pd.DataFrame(np.concatenate(found), columns=["a", "b"]))
    out = minhash._tiles(members, values, compare).collect()
    assert sum(-1 - r.a for r in out) == 60 + 3 * 8 + 3  # the smaller ones' tile with each of 8 blocks, and their own
    assert sum(r.b for r in out) == 60 * 3 + 3 * 2


def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)]
    links += [(500, k) for k in range(501, 560)] + [(7, 7)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    out = {r.id: r.component_id for r in components(df).collect()}
    ids = {i for link in links for i in link}
    want = {i: c for i, c in smallest_reachable(ids, links).items() if i != c}
    assert out == want
    assert components(df.limit(0)).collect() == []


# --- op9 ----------------------------------------------------------------------------------


def test_embeddings_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 40)
    monkeypatch.setattr(embeddings, "STRIP", 16)
    draw = np.random.default_rng(2)
    base = draw.normal(size=(30, 12))
    vectors = [base[k % 30] + draw.normal(size=12) * draw.choice([0, 0.05, 0.13, 0.2]) for k in range(240)]
    vectors += [2 * vectors[0], vectors[1], -vectors[2]]
    rows = [(k * 3 + 1, [float(x) for x in v]) for k, v in enumerate(vectors)]
    bad = [(2, None), (5, []), (8, [0.0] * 12), (11, [float("nan")] * 12), (14, [None] * 12), (17, [float("inf")] * 12), (20, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").selectExpr("*", "1 AS label", "2 AS rep", "3 AS key")
    unit = np.stack(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    links = [(rows[a][0], rows[b][0]) for a, b in zip(*np.nonzero(np.triu(close, 1)))]
    label = smallest_reachable([r[0] for r in rows], links)
    out = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    assert len(out) == len(rows) + len(bad)
    for k, (vec_id, _) in enumerate(rows):
        row = out[vec_id]
        assert (row.n_links, row.component_id, row.kept) == (close[k].sum() - 1, label[vec_id], label[vec_id] == vec_id)
    assert all(out[i].n_links == 0 and out[i].kept for i, _ in bad)
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_quantisation_bound_holds():
    draw = np.random.default_rng(8)
    unit = draw.normal(size=(300, 64)) * np.exp(draw.normal(size=(300, 64)))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q, s, e = embeddings.quantise(unit)
    near = (q.astype(float) @ q.astype(float).T) * s[:, None] * s[None, :]
    bound = e[:, None] + (1 + e)[:, None] * e[None, :]
    assert (np.abs(near - unit @ unit.T) <= bound + 1e-12).all()


@pytest.mark.parametrize("threshold", [0.95, 0.3, 0.001, -0.5])
def test_open_pairs_are_those_whose_bound_reaches_the_threshold(monkeypatch, threshold):
    monkeypatch.setattr(embeddings, "STRIP", 16)
    draw = np.random.default_rng(9)
    unit = draw.normal(size=(200, 32)) * np.exp(draw.choice([0.1, 2.5], (200, 1)) * draw.normal(size=(200, 32)))
    unit[150:] = unit[:50] + 0.02 * draw.normal(size=(50, 32))
    unit[0] = np.eye(32)[3]
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    q, s, e = embeddings.quantise(unit)
    near = (q.astype(float) @ q.astype(float).T) * s[:, None] * s[None, :]
    bound = near + e[:, None] + (1 + e)[:, None] * e[None, :] + embeddings.ROUNDING
    found = set(zip(*(v.tolist() for v in embeddings.open_pairs((q, s, e), (q, s, e), threshold))))
    assert found == set(zip(*(v.tolist() for v in np.nonzero(bound >= threshold))))
    assert found >= set(zip(*(v.tolist() for v in np.nonzero(unit @ unit.T >= threshold))))


def test_tiles_get_codes_and_only_open_vectors_in_full(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 25)
    tables, written = {}, embeddings.stored
    monkeypatch.setattr(embeddings, "stored", lambda df, name: tables.setdefault(name, written(df, name)))
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(200, 48))
    vectors[100] = vectors[7] + 0.01 * draw.normal(size=48)
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows.append((7, [float(x) for x in vectors[50]]))  # an id with another vector, and a copy of vector 50
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = [r for r in embeddings.near_duplicates(df).collect() if r.n_links]
    assert sorted((r.vec_id, r.n_links) for r in out) == [(7, 1), (7, 1), (50, 1), (100, 1)]
    codes = tables["codes"]
    assert [f.dataType.simpleString() for f in codes.schema] == ["int", "bigint", "bigint", "bigint", "binary", "double", "double"]
    assert {len(r.code) for r in codes.collect()} == {48}
    opened = tables["open"].join(tables["classes"], "cls").collect()
    assert {(r.rep, r.copies) for r in opened} == {(7, 1), (100, 1)}


# --- op7 ----------------------------------------------------------------------------------


def test_contamination(spark, frame, odd, empty):
    draw = random.Random(6)
    item = [f"b{k}" for k in range(40)]
    noise = lambda n: [draw.choice(["the", "of", "and", "x", "y"]) for _ in range(n)]
    rows = {
        1: noise(50) + item + noise(50), 2: item[20:] + noise(9) + item[:20], 3: noise(400), 4: item[:15] + noise(60),
        5: [w.upper() + "," for w in item], 6: item[:10] + noise(3) + item[25:35] + noise(3) + item[12:20],
        7: [w for k, w in enumerate(item) if k % 5], 8: item * 3, 9: item[:4],
    }
    bench = spark.createDataFrame([(100, " ".join(item)), (101, "too short"), (102, None), (None, "x y the of and")], "item_id long, text string")
    bench = bench.selectExpr("*", "1 AS doc_id", "2 AS coverage")
    docs = frame([(i, " ".join(w), None) for i, w in rows.items()])
    out = {r.doc_id: r for r in decontamination.contamination(docs, bench).collect()}
    assert {i for i, r in out.items() if r.contaminated} == {1, 2, 5, 6, 8}
    assert out[1].coverage == 1.0 and out[2].coverage == 1.0 and out[6].coverage == 28 / 40 and out[1].item_ids == [100]
    assert out[3].coverage == 0.0 and out[3].item_ids == []
    assert sorted(r.doc_id for r in decontamination.clean(docs, bench).collect()) == [3, 4, 7, 9]
    assert not any(r.contaminated for r in decontamination.contamination(odd, bench).collect())
    assert decontamination.contamination(odd, bench).count() == odd.count()
    assert decontamination.contamination(empty, bench).collect() == []
    assert not any(r.contaminated for r in decontamination.contamination(docs, bench.limit(0)).collect())


def test_benchmark_in_blocks_gives_the_same(spark, documents, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(str, decontamination.leaks(documents, bench).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 300)
    assert whole and sorted(map(str, decontamination.leaks(documents, bench).collect())) == whole


def test_tiles_are_greedy_and_disjoint():
    draw = random.Random(7)
    for _ in range(200):
        doc, item = (np.array([draw.randrange(4) for _ in range(n)], np.uint64) for n in (60, 25))
        tiles = decontamination.tile(doc, item, 3)
        used_doc, used_item = np.zeros(60, bool), np.zeros(25, bool)
        for length, i, j in tiles:
            assert (doc[i : i + length] == item[j : j + length]).all() and length >= 3
            assert not used_doc[i : i + length].any() and not used_item[j : j + length].any()
            used_doc[i : i + length] = used_item[j : j + length] = True
        for i in range(58):
            for j in range(23):
                free = not used_doc[i : i + 3].any() and not used_item[j : j + 3].any()
                assert not (free and (doc[i : i + 3] == item[j : j + 3]).all())


def plain_tiles(doc, item, least):
    """Greedy string tiling word by word: always the longest free match, ties by place."""
    used, taken, tiles = set(), set(), []

    def length(i, j):
        n = 0
        while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and i + n not in used and j + n not in taken:
            n += 1
        return n

    while True:
        size, i, j = max(((length(i, j), i, j) for i in range(len(doc)) for j in range(len(item))), default=(0, 0, 0), key=lambda m: (m[0], -m[1], -m[2]))
        if size < least:
            return tiles
        tiles.append((size, i, j))
        used |= set(range(i, i + size))
        taken |= set(range(j, j + size))


def test_tiles_against_a_plain_tiler():
    draw = random.Random(11)
    for _ in range(300):
        letters, least = draw.choice([1, 2, 3, 6]), draw.choice([2, 3, 5])
        doc, item = ([draw.randint(1, letters) for _ in range(draw.randint(0, most))] for most in (40, 25))
        found = decontamination.tile(np.array(doc, np.uint64), np.array(item, np.uint64), least)
        assert found == plain_tiles(doc, item, least)


def test_repetitive_texts_take_linear_memory():
    word = words.mix(np.arange(8, dtype=np.uint64))
    doc, item = word[np.arange(20_000) % 8], word[np.arange(1000) % 8]
    one, same = np.repeat(word[:1], 20_000), np.repeat(word[:1], 1000)
    cut = one.copy()
    cut[::7] = word[1]
    tracemalloc.start()
    assert decontamination.tile(doc, item) == [(1000, 0, 0)] and decontamination.tile(one, same) == [(1000, 0, 0)]
    assert sum(t[0] for t in decontamination.tile(cut, same)) == 996 + 0
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_vectors_of_any_scale_link(spark):
    rows = [(1, [1e200, 2e200]), (2, [1e-200, 2e-200]), (3, [1.0, 2.0]), (4, [5e-324, 1e-323]), (5, [-1.0, 2.0]), (6, [1e308, 1e308])]
    out = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [out[i].component_id for i in (1, 2, 3, 4)] == [1] * 4 and out[5].n_links == 0
    # (1, 1) and (1, 2) have a cosine of 0.9487
    assert out[6].n_links == 0 and [out[i].n_links for i in (1, 2, 3, 4)] == [3] * 4
