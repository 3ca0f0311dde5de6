"""Word hashes: words built to collide under polynomial hashes, long words, equal words anywhere."""

import numpy as np
from tickermill.llm import minhash, substrings, words

from .conftest import by_id
from .test_pair_operators import brute_groups
from .test_text_operators import brute_removal


def thue_morse(length, letters="ab"):
    return "".join(letters[bin(k).count("1") % 2] for k in range(length))


ONE, OTHER = thue_morse(2048), thue_morse(2048, "ba")


def hashed(text, seed=0):
    data = np.frombuffer(text.encode(), np.uint8)
    return words.hashes(data, *words.spans(data), seed=seed).tolist()


def test_equal_words_and_no_others_share_a_hash():
    lengths = (1, 7, 8, 9, 16, 17, 255, 256, 257, 1000)
    pool = [*(thue_morse(n) for n in lengths), *("x" * n for n in lengths), *(f"w{k}" for k in range(5000)), ONE, OTHER, "é", "日本"]
    pool += [thue_morse(128), thue_morse(128, "ba"), thue_morse(64), thue_morse(64, "ba")]
    pool = sorted(set(pool))
    for seed in (0, 1):
        assert len(set(hashed(" ".join(pool), seed))) == len(pool)
        assert hashed(" \t".join(pool) + "\n", seed) == hashed("  ".join(pool), seed)
    assert not set(hashed(" ".join(pool), 0)) & set(hashed(" ".join(pool), 1))
    assert hashed("") == hashed(" \n") == []


def test_windows_that_differ_in_such_a_word_stay(frame):
    plain = [f"v{k}" for k in range(60)]
    texts = {1: " ".join([*plain[:30], ONE, *plain[30:]]), 2: " ".join([*plain[:30], OTHER, *plain[30:]])}
    sequence = thue_morse(4096)
    texts |= {3: " ".join(sequence), 4: " ".join(thue_morse(4096, "ba"))}
    rows = by_id(substrings.digests(frame([(i, t, "en") for i, t in texts.items()])))
    want = brute_removal(texts, 50)
    assert {i: (r.n_words, r.n_removed) for i, r in rows.items()} == {i: v[:2] for i, v in want.items()}
    assert rows[2].n_removed == 0


def test_such_words_are_no_near_duplicates(frame):
    texts = {1: ONE, 2: OTHER, 3: ONE, 4: f"a b c {ONE} d", 5: f"a b c {OTHER} d"}
    rows = by_id(minhash.near_duplicates(frame([(i, t, "en") for i, t in texts.items()])))
    _, label = brute_groups(texts)
    assert {i: r.component_id for i, r in rows.items()} == label
    assert label[1] == label[3] == 1 and label[2] == 2 and label[4] != label[5]
