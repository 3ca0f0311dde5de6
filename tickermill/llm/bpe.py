"""BPE encoding by dynamic programming over prefixes, and decoding, for word-level BPE files.

Every prefix of a word has exactly one last token: the token that is a suffix of the prefix and
that is compatible with the last token of what stands before it. A suffix automaton of the
vocabulary names the suffixes that are tokens, a test on the merges says whether two tokens can stand
side by side, and the back-pointers of the whole word give its ids. The time is linear in the length
of a word, however long it is.

The tokenizer file is read by every Python worker from `tokenizer` (a path that all machines have).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickermill.llm import words

SLICE = 256
WORDS_KEPT = 1 << 18  # words of at most 64 letters whose ids each worker remembers
PAIRS_KEPT = 1 << 19  # slots of 8 bytes for tests of token pairs
SYMBOLS = 1 << 10  # more than a file's base symbols

# Fixed values of the file format: the printable character that stands for each byte, the mark of a
# word's end, and the pattern that cuts lower-cased text into words.
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
OTHERS = [b for b in range(256) if b not in PRINTABLE]
BYTE_CHARS = {b: chr(b) for b in PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(OTHERS)}


def _latin(pattern: str) -> str:
    """The pattern with its Unicode classes spelled out for the first 256 characters."""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(f"\\x{c:02x}" for c in range(256) if regex.fullmatch(name, chr(c)))
        pattern = pattern.replace(name, members)
    return pattern


class PrefixEncoder:
    """Tokens, merges and suffix automaton of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.text = {i: t for t, i in model["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text |= {i: t for t, i in self.specials.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.latin_words = re.compile(_latin(pattern))
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

        ids = self.vocabulary = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[left], ids[right]
            self.rank[pair] = rank
            self.parts[ids[left + right]] = (*pair, rank)
        self.pairs = array("q", [-1]) * PAIRS_KEPT
        self._build(ids)
        self.names = np.full(max(self.text) + 1, "", object)
        self.names[list(self.text)] = list(self.text.values())

    def symbols(self, token: str) -> list[str]:
        """Base symbols of a token: its characters, the last one joined with a word's end mark."""
        if token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _build(self, ids: dict[str, int]) -> None:
        """Suffix automaton of all tokens. A whole token is always the longest string of its state."""
        length, link, step, token = [0], [-1], [{}], [-1]
        for text, number in ids.items():
            last = 0
            for symbol in self.symbols(text):
                known = step[last].get(symbol)
                if known is not None and length[known] == length[last] + 1:
                    last = known
                    continue
                if known is None:
                    new = len(length)
                    length.append(length[last] + 1)
                    link.append(0)
                    step.append({})
                    token.append(-1)
                    at = last
                    while at >= 0 and symbol not in step[at]:
                        step[at][symbol] = new
                        at = link[at]
                    if at >= 0:
                        found = step[at][symbol]
                        link[new] = found if length[found] == length[at] + 1 else self._clone(length, link, step, token, at, symbol)
                    last = new
                else:
                    last = self._clone(length, link, step, token, last, symbol)
            token[last] = number
        # The nearest state above, itself excluded, whose longest string is a token.
        above = [-1] * len(length)
        for state in sorted(range(1, len(length)), key=length.__getitem__):
            up = link[state]
            above[state] = up if token[up] >= 0 else above[up]
        # Flat arrays, and one table of all steps: a state's number and a symbol's code give the next state.
        self.code: dict[str, int] = {}
        self.go: dict[int, int] = {}
        for state, steps in enumerate(step):
            for symbol, after in steps.items():
                self.go[state * SYMBOLS + self.code.setdefault(symbol, len(self.code))] = after
        if len(self.code) >= SYMBOLS:
            raise ValueError("too many base symbols")
        self.length, self.link, self.token, self.above = (array("i", x) for x in (length, link, token, above))

    @staticmethod
    def _clone(length, link, step, token, at, symbol) -> int:
        found = step[at][symbol]
        new = len(length)
        length.append(length[at] + 1)
        link.append(link[found])
        step.append(dict(step[found]))
        token.append(-1)
        link[found] = new
        while at >= 0 and step[at].get(symbol) == found:
            step[at][symbol] = new
            at = link[at]
        return new

    def can_follow(self, left: int, right: int) -> bool:
        """Whether encoding both texts together keeps the two tokens.

        It does not if a merge joins a piece that ends the left token with a piece that starts the
        right one before either piece is used up by its own token's merges (left first on a tie).
        """
        never = len(self.rank)
        starts, used = [], never
        piece = right
        while True:
            starts.append((piece, used))
            if piece not in self.parts:
                break
            piece, _, used = self.parts[piece]
        piece, used = left, never
        while True:
            for other, until in starts:
                rank = self.rank.get((piece, other))
                if rank is not None and rank < used and rank <= until:
                    return False
            if piece not in self.parts:
                return True
            _, piece, used = self.parts[piece]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word as cut by the pattern."""
        chars = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(BYTE_CHARS)
        whole = self.vocabulary.get(chars + self.end)
        if whole is not None:  # a token always encodes to itself
            return [whole]
        length, link, go, token, above = self.length, self.link, self.go, self.token, self.above
        pairs, code = self.pairs, self.code
        last, size = [-1], [0]
        state = matched = 0
        for symbol in [*chars[:-1], chars[-1] + self.end]:
            symbol = code.get(symbol, SYMBOLS - 1)  # the last code stands for unknown ones
            up = go.get(state * SYMBOLS + symbol)
            while up is None and state:
                state = link[state]
                matched = length[state]
                up = go.get(state * SYMBOLS + symbol)
            if up is None:  # not in the vocabulary at all: dropped, as the model has no unknown token
                last.append(last[-1])
                size.append(0)
                continue
            state = up
            matched += 1
            at = state if token[state] >= 0 and length[state] == matched else above[state]
            while at >= 0:
                before = last[-length[at]]
                if before < 0:
                    break
                pair = before << 32 | token[at]
                slot = (before * 40503 + token[at]) % PAIRS_KEPT
                if pairs[slot] >> 1 != pair:
                    pairs[slot] = pair << 1 | self.can_follow(before, token[at])
                if pairs[slot] & 1:
                    break
                at = above[at]
            last.append(token[at])
            size.append(length[at])
        ids, k = [], len(last) - 1
        while k > 0:
            if size[k]:
                ids.append(last[k])
            k -= size[k] or 1
        return ids[::-1]

    def pieces(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        # Character by character, so a capital sigma gives the same small letter everywhere.
        text = text.replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.words.findall(text)
        return self.latin_words.findall(text)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.special.split(text):
            if part in self.specials:
                ids.append(self.specials[part])
            else:
                for word in self.pieces(part):
                    ids.extend(self.encode_word(word))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: token texts joined by spaces, unknown ids left out."""
        return " ".join(self.text[i] for i in ids if i in self.text)


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(path)


class _Memory(dict):
    """Ids of the words that one worker has met, as bytes; of the older half only used words stay."""

    def __init__(self, own: PrefixEncoder):
        super().__init__()
        self.own, self.older = own, {}

    def __missing__(self, word: str):
        out = self.older.get(word)
        if out is None:
            out = np.array(self.own.encode_word(word), "<u4").tobytes()
        if len(self) >= WORDS_KEPT // 2:
            self.older = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = out
        return out


@lru_cache(maxsize=2)
def _memory(path: str) -> _Memory:
    return _Memory(encoder(path))


def _encoded(text: str | None, path: str) -> np.ndarray:
    """Ids of a text; null counts as empty."""
    own, memory = encoder(path), _memory(path)
    ids = []
    for part in own.special.split(text or ""):
        if part in own.specials:
            ids.append(np.array([own.specials[part]], "<u4").tobytes())
        else:
            ids.extend(map(memory.__getitem__, own.pieces(part)))
    return np.frombuffer(b"".join(ids), "<u4")


def encode(text: Column, tokenizer: str) -> Column:
    """Array of token ids of a text; null and empty texts, and texts of white space, give none."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([_encoded(t, tokenizer).astype(np.int32) for t in texts])

    return ids(text)


def decode(ids: Column, tokenizer: str) -> Column:
    """Text of an array of token ids; a null or empty array gives an empty text."""

    @F.pandas_udf("string")
    def texts(arrays: pd.Series) -> pd.Series:
        own = encoder(tokenizer)
        return pd.Series([own.decode(list(a)) if a is not None else "" for a in arrays], dtype=object)

    return texts(ids)


def tokenise(docs: DataFrame, tokenizer: str, text_column: str = "text") -> DataFrame:
    """`docs` with the text replaced by ids (array<int>), n_tokens, ids_sha256 and decoded_sha256.

    Ids leave the task in slices of SLICE documents as flat arrays, so that a task holds few of them.
    """
    added = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    rest = [c for c in docs.columns if c not in (text_column, *added)]

    def encoded(batches):
        words.release_memory()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = [_digest(text, tokenizer) for text in part.column(len(rest)).to_pylist()]
                ends = np.cumsum([0, *(row[1] for row in rows)]).astype(np.int32)
                flat = np.frombuffer(b"".join([row[0] for row in rows]), "<u4").astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
                columns += [pa.array(list(column)) for column in zip(*(row[1:] for row in rows))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *columns], [*rest, *added])

    own = docs.select(*rest, F.col(text_column).cast("string").alias(text_column))
    types = [T.ArrayType(T.IntegerType()), T.LongType(), T.StringType(), T.StringType()]
    schema = T.StructType([*own.schema.fields[:-1], *map(T.StructField, added, types)])
    return own.mapInArrow(encoded, schema)


def _digest(text: str | None, path: str) -> tuple[bytes, int, str, str]:
    ids = _encoded(text, path)
    # As `decode` gives it: every id is a token here.
    decoded = " ".join(encoder(path).names[ids].tolist())
    code = ids.tobytes()
    return code, len(ids), hashlib.sha256(code).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def digests(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_tokens, ids_sha256 and decoded_sha256.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers, decoded_sha256 over the
    decoded text in UTF-8. Ids and decoded texts stay in the task, so any text length is fine. A null
    text counts as empty; repeated rows give repeated results; other columns are ignored.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(texts: pd.Series) -> pd.DataFrame:
        rows = [_digest(text, tokenizer)[1:] for text in texts]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(id_column).alias("doc_id"), digest(F.col(text_column).cast("string")).alias("d"))
    return out.select("doc_id", "d.*")
