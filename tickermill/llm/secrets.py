"""Secrets by multipart credential linking, with DataFrame and SQL functions only.

Base kinds (assign, access, hex) are reported as they match. Weak candidates (identifiers, opaque tokens,
loose keys and endpoints) mean nothing alone; they are reported only where complementary parts stand
within one scope: an identifier needs a secret, a secret an identifier, an endpoint needs both. Base
spans count as parts (access as identifier, assign and hex as secrets). The parts of documents that
have complementary ones are joined as intervals: both sides are dealt to scope-wide cells of their
document and compared within a cell only, so a pair of parts meets where it is close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill.llm.spans import joined, sha256, with_matches
from tickermill.session import stored

BASE = ["assign", "access", "hex"]
WEAK = {"identifier": "identifier", "opaque": "secret", "loose_key": "secret", "endpoint": "endpoint"}
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", **WEAK}
SCOPE = 240  # code points between two parts of one credential
MASK = "[SECRET]"

# kind: (cheap condition, pattern); linear-time forms of the base patterns, see the tests.
PATTERNS = {
    "assign": (
        "text rlike '(?i)(password|passwd|secret|token|api_?key)'",
        r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++""",
    ),
    "access": ("contains(text, 'AKIA')", r"AKIA[A-Z0-9]{16,}+"),
    "hex": ("true", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
    "identifier": (
        "text rlike '(?i)(client|account|access|key|user|login)'",
        r"""(?<![A-Za-z0-9])(?i:client_?id|account_?id|access_?key_?id|key_?id|user_?name|user_?id|user|login)"""
        r"""["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9@._+-]{3,}+""",
    ),
    "opaque": ("true", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}+=*+(?![A-Za-z0-9])"),
    "loose_key": (
        "text rlike '(?i)(pwd|pass|auth|bearer|credential|private_?key|access_?key)'",
        r"""(?<![A-Za-z0-9])(?i:pwd|pass|auth|bearer|credentials?|private_?key|access_?key)"""
        r"""["']?+(?:\x20*+[:=]|\x20)\x20*+["']?+[A-Za-z0-9+/_.=-]{8,}+""",
    ),
    "endpoint": (
        "contains(text, '://')",
        r"""(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\s"'<>]{3,}+""",
    ),
}
# Value of an assignment: what follows the name and the sign.
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
CHECKS = {
    "assign": f"length(regexp_extract(x.body, '{_VALUE.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}', 1)) >= 6",
    "opaque": "x.body rlike '[0-9]' and x.body rlike '[A-Z]' and x.body rlike '[a-z]'",
    "loose_key": "x.body rlike '[0-9][^0-9]*[0-9]'",
}
KINDS = [*BASE, *WEAK]


def _spans(kind: str) -> str:
    place = f"named_struct('s', x.s, 'rank', {KINDS.index(kind)}, 'kind', '{kind}', 'e', x.e)"
    return f"transform(filter({kind}, x -> {CHECKS.get(kind, 'true')}), x -> {place})"


def _roles(spans: str, role: str) -> str:
    kinds = ", ".join(repr(k) for k, r in ROLES.items() if r == role)
    return f"exists({spans}, x -> x.kind in ({kinds}))"


def _key(id_column: str, text: str) -> Column:
    """What tells rows apart: id (it may be null) and text."""
    return F.sha2(F.concat_ws(":", F.coalesce(F.col(id_column).cast("long").cast("string"), F.lit("")), F.col(text).cast("string")), 256)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, key (digest of id and text), base and all_spans, arrays of (s, rank, kind, e).

    Spans are in code points, ordered by start and kind. Null and empty texts have none; rows that
    repeat an id, or have none, are told apart by their text. Texts of any length are searched whole:
    parts are compared within cells of their document. Other columns are ignored.
    """
    own = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    matched = with_matches(own, "text", PATTERNS)
    found = matched.select(
        "doc_id",
        _key("doc_id", "text").alias("key"),
        F.array_sort(F.concat(*[F.expr(_spans(k)) for k in BASE])).alias("base"),
        F.concat(*[F.expr(_spans(k)) for k in WEAK]).alias("weak"),
    )
    clear = F.expr("filter(weak, x -> not exists(base, b -> b.s < x.e and x.s < b.e))")
    found = stored(found.withColumn("weak", clear), "found")

    complete = F.expr(f"{_roles('parts', 'identifier')} and {_roles('parts', 'secret')}")
    parts = (
        found.where("size(weak) > 0")
        .withColumn("parts", F.concat("base", "weak"))
        .where(complete)
        .select("key", F.explode("parts").alias("p"))
        .select("key", "p.*")
        .distinct()
    )
    role = F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), F.col("kind"))
    parts = stored(parts.withColumn("role", role), "parts")
    asking = parts.where(F.col("kind").isin(list(WEAK))).withColumn(
        "cell", F.explode(F.array_distinct(F.array(F.expr(f"s div {SCOPE}"), F.expr(f"e div {SCOPE}"))))
    )
    other = parts.where("role != 'endpoint'").select(
        "key",
        F.col("s").alias("s2"),
        F.col("e").alias("e2"),
        F.col("role").alias("role2"),
        F.explode(F.expr(f"sequence((s - {SCOPE}) div {SCOPE} - 1, (e + {SCOPE}) div {SCOPE})")).alias("cell"),
    )
    close = f"s2 - e <= {SCOPE} and s - e2 <= {SCOPE} and role != role2"
    linked = (
        asking.join(other, ["key", "cell"])
        .where(close)
        .groupBy("key", "s", "rank", "kind", "e", "role")
        .agg(F.count_distinct("role2").alias("roles"))
        .where("roles = if(role = 'endpoint', 2, 1)")
    )
    added = linked.groupBy("key").agg(F.collect_list(F.struct("s", "rank", "kind", "e")).alias("added"))
    nothing = F.expr("cast(array() as array<struct<s: bigint, rank: int, kind: string, e: bigint>>)")
    out = found.join(stored(added, "added"), "key", "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", nothing)))
    return out.select("doc_id", "key", "base", every.alias("all_spans"))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, counts of the base kinds, base_sha256 and spans (see `scan`)."""
    own = scan(docs, id_column, text_column)
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = '{k}')))").alias(f"n_{k}") for k in BASE]
    return own.select("doc_id", *counts, sha256(joined("base")).alias("base_sha256"), joined("all_spans").alias("spans"))


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`docs` with every reported span of the text replaced by a mask; other columns stay.

    Null and empty texts stay as they are; rows that repeat an id, or have none, are masked each by its
    own text, and repeated rows alike. Texts of any length are masked whole.
    """
    spans = scan(docs, id_column, text_column).where("size(all_spans) > 0")
    spans = spans.select(F.col("key").alias("__key"), F.col("all_spans").alias("__spans")).dropDuplicates(["__key"])
    text = F.col(text_column).cast("string")
    joined_docs = docs.join(spans, _key(id_column, text_column) == F.col("__key"), "left")
    masked = F.expr(
        "aggregate(__spans, named_struct('at', 1L, 'out', ''), (a, x) -> if(x.e < a.at, a, named_struct('at', x.e + 1, 'out',"
        f" if(x.s + 1 < a.at, a.out, concat(a.out, substring(`{text_column}`, int(a.at), int(x.s + 1 - a.at)), '{MASK}')))),"
        f" a -> concat(a.out, substring(`{text_column}`, int(a.at))))"
    )
    return joined_docs.withColumn(text_column, F.when(F.col("__spans").isNull(), text).otherwise(masked)).select(docs.columns)
