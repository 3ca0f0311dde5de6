"""Packing, source divergence and the prefix trie against plain counterparts, with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tickermill.llm import divergence, packing, trie
from tokenizers import Tokenizer

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- packing ------------------------------------------------------------------------------

def best_sum(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1) if s + length * k <= room}
    return max(sums)


def test_closest_filling_is_closest():
    random.seed(1)
    for _ in range(200):
        counts = {random.randint(1, 40): random.randint(0, 4) for _ in range(6)}
        room = random.randint(0, 64)
        chosen = packing.closest_filling(counts, room)
        assert all(counts[x] >= n > 0 for x, n in chosen.items())
        assert sum(x * n for x, n in chosen.items()) == best_sum(counts, room)


@pytest.mark.parametrize("seed", range(40))
def test_places_use_every_id_once_and_pad_nothing(seed):
    random.seed(seed)
    capacity = random.choice([8, 16, 64, 1024])
    counts = {random.randint(1, capacity): random.randint(1, random.choice([2, 50])) for _ in range(random.choice([1, 3, 100]))}
    taken, inside = collections.defaultdict(list), collections.defaultdict(list)
    for kind, first, after, cut, until, sequence, used, each, at in packing.places(counts, capacity):
        for rank in range(first, after):
            k = used + rank - first
            inside[sequence + k // each].append((at + k % each * (until - cut), until - cut))
            taken[kind, rank].append((cut, until))
    assert set(taken) == {(x, r) for x, n in counts.items() for r in range(n)}
    for (kind, _), parts in taken.items():
        parts.sort()
        assert [0, *(u for _, u in parts)] == [*(c for c, _ in parts), kind]
    assert sorted(inside) == list(range(len(inside)))
    for parts in inside.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end == capacity or (end < capacity and end & (end - 1) == 0)
    assert sum(sum(n for _, n in parts) < capacity for parts in inside.values()) < capacity.bit_length()


def test_places_of_huge_counts():
    rows = packing.places({700: 10**12, 3: 10**12, 1024: 5})
    assert len(rows) < 1000
    assert sum((r[2] - r[1]) * (r[4] - r[3]) for r in rows) == 703 * 10**12 + 5 * 1024


def check_packing(rows, texts, capacity):
    """Every id of every document in one piece, offsets gapless, checksums right."""
    library = Tokenizer.from_file(TOKENIZER)
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = [*library.encode(texts[doc] or "", add_special_tokens=False).ids, 0]
        end = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (end, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
            end += r.length
        assert end == len(ids)
    for parts in by_sequence.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end == capacity or end & (end - 1) == 0 and end < capacity


def test_pack_documents(documents):
    rows = packing.pack(documents, TOKENIZER).collect()
    check_packing(rows, {r.doc_id: r.text for r in documents.collect()}, 1024)
    whole = sum(r.length == 1024 for r in rows)
    assert whole and all(r.offset == 0 for r in rows if r.length == 1024)


def test_packed_sequences_hold_the_ids(documents):
    some = documents.where("doc_id < 40")
    packed = packing.pack(some, TOKENIZER, capacity=256, keep_ids=True)
    rows = packed.collect()
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    made = packing.sequences(packed).collect()
    assert sum(r.length for r in made) == sum(r.length for r in rows)
    assert all(len(r.ids) == 4 * r.length for r in made)
    first = {r.sequence_id: r for r in rows if r.offset == 0}
    assert all(bytes(r.ids).startswith(bytes(first[r.sequence_id].ids)) for r in made)
    assert all(r.doc_ids[0] == first[r.sequence_id].doc_id for r in made)


def test_pack_odd_rows(odd, empty, frame):
    assert packing.pack(empty, TOKENIZER).collect() == []
    rows = packing.pack(odd, TOKENIZER).collect()
    assert sum(r.length for r in rows if r.doc_id == 2) == 1  # a null text is the end id alone
    assert sum(r.length for r in rows if r.doc_id == 8) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 8)
    assert sum(r.length for r in rows if r.doc_id is None) > 1
    spaces = {1: " " * 300_000 + "x <|endoftext|> y", 2: "a" * 100_000, 3: "İß ΣΣ 🙂"}
    check_packing(packing.pack(frame([(k, t, "en") for k, t in spaces.items()]), TOKENIZER).collect(), spaces, 1024)


# --- divergence ---------------------------------------------------------------------------

def brute_divergence(rows, min_docs):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen, counts, groups = collections.Counter(), collections.Counter(), collections.defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        words = word.findall((text or "").translate(lower))
        seen.update((lang, w) for w in set(words))
        counts.update((lang, source, w) for w in words)
    out = set()
    for lang, sources in groups.items():
        kept = [w for (own, w), n in seen.items() if own == lang and n >= min_docs]
        n = {s: sum(counts[lang, s, w] for w in kept) for s in sources}
        p = lambda s, w: 1 + 10**9 * (counts[lang, s, w] + 2) // (n[s] + 2 * len(kept))
        q = lambda w: 1 + 10**9 * (sum(counts[lang, s, w] for s in sources) + 2) // (sum(n.values()) + 2 * len(kept))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p(s, w), p(t, w)) for w in kept), t.encode()) for t in sources - {s}]
            terms = [(-f(p(s, w), q(w)), w.encode()) for w in kept if counts[lang, s, w] and p(s, w) > q(w)]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out |= {(lang, s, part, item.decode(), -value, k) for k, (value, item) in enumerate(ranked, 1)}
    return out


ODD_TEXTS = [
    ("Same same WORDS here", "en", "a"), ("same words é É there", "en", "b"), ("same, words; HERE_x", "en", "a"), (None, "en", "c"),
    ("", "en", None), ("same\x00words", None, "a"), ("same words", None, "b"), ("same words", None, "b"), ("123 !!", "de", "a"),
    ("nur eins", "fr", "x"), ("tie one two", "en", "b"), ("tie two one", "en", "a"),
]


@pytest.mark.parametrize("block", [divergence.BLOCK, 3])
def test_divergence(spark, monkeypatch, block):
    monkeypatch.setattr(divergence, "BLOCK", block)
    df = spark.createDataFrame(ODD_TEXTS, "text string, lang string, source string").selectExpr("*", "1 AS n", "2 AS term", "3 AS p", "4 AS value")
    rows = {tuple(r) for r in divergence.audit(df, min_docs=2).collect()}
    assert rows == brute_divergence(ODD_TEXTS, 2)
    assert divergence.audit(df.limit(0)).collect() == []


def test_divergence_of_documents(spark, documents):
    some = documents.selectExpr("text", "lang", "concat('s', doc_id % 3) AS source")
    rows = {tuple(r) for r in divergence.audit(some).collect()}
    assert rows == brute_divergence([tuple(r) for r in some.collect()], 10) and len(rows) > 50


def test_shares_beyond_64_bits(spark):
    count = 7 * 10**17
    df = spark.createDataFrame([(count, 3 * 10**18, 10)], "n long, total long, v long")
    assert df.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * (count + 2) // (3 * 10**18 + 20)
    assert divergence._exact_shares(np.array([count]), 3 * 10**18, 10)[0] == 1 + 10**9 * (count + 2) // (3 * 10**18 + 20)


# --- prefix trie --------------------------------------------------------------------------

def brute_trie(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            by[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [turn for _, turn in sorted(v)] for c, v in by.items()}
    sequences = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        sequences[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(sequences[c]) == len(p))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
        for p, m in members.items()
    )


def nodes(df, **limits):
    return sorted(
        (r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in trie.prefix_trie(df, **limits).collect()
    )


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard_turns", [trie.SHARD_TURNS, 40, 1])
def test_trie_of_conversations(spark, shard_turns):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert nodes(df, shard_turns=shard_turns) == brute_trie([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("shard_turns", [trie.SHARD_TURNS, 30])
def test_trie_of_odd_rows(spark, shard_turns):
    random.seed(3)
    rows = [(None, 0, "user", "no conversation"), (5, None, None, None), (5, None, "user", "x y"), (5, 1, "user", "x y"), (5, 1, "user", "x y"), (21, 0, None, "alone")]
    rows += [(40 + k, t, "user", "same opening") for k in range(400) for t in range(k % 3 + 1)]  # hot prefixes
    rows += [(600, t, "user", f"long {t}") for t in range(900)]
    rows += [(601, t, "user", f"long {t}") for t in range(700)]
    rows += [(random.randint(700, 760), random.randint(0, 3), random.choice(["a", "b"]), random.choice(["", "p", "q r"])) for _ in range(400)]
    df = spark.createDataFrame(rows, CONV).selectExpr("*", "1 AS id", "2 AS own", "3 AS words", "4 AS key")
    assert nodes(df, shard_turns=shard_turns) == brute_trie(rows)
    assert nodes(df.limit(0)) == []


def test_trie_of_turnless_conversations(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 20)]  # the block's first conversation does not exist
    made = nodes(spark.createDataFrame(rows, CONV))
    assert made == brute_trie(rows) and made[0][3] == 19


def test_medians_are_a_balanced_order():
    order = list(trie._medians(1000))
    assert sorted(order) == list(range(1000)) and order[0] == 500
