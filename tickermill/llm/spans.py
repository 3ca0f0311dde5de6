"""Positions of regular-expression matches in texts, with built-in functions only.

`split` gives the text between the matches that `regexp_extract_all` returns, so running sums of their
lengths are the positions, in code points. The sums are taken in blocks, so the cost stays close to
the number of matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
CONTEXT = 48  # code points of text kept before a match

_RUNNING = (
    "aggregate({0}, named_struct('t', 0L, 'o', cast(array() as array<bigint>)),"
    " (a, x) -> named_struct('t', a.t + x, 'o', array_append(a.o, a.t)), a -> a.o)"
)


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """`df` with one array column per kind: (s, e, body, before, after) of its leftmost matches, in order.

    `patterns` maps the kind to (condition, pattern): where the condition does not hold there is no
    match, so cheap tests keep the pattern from most texts. s and e are code points, e exclusive;
    `before` is the end of the text between the match and the one before it, `after` one character.
    Null texts have no matches.
    """
    quoted = {kind: pattern.replace("\\", "\\\\").replace("'", "\\'") for kind, (_, pattern) in patterns.items()}
    df = df.withColumns(
        {
            f"{kind}_b": F.expr(f"if({condition}, regexp_extract_all({text}, '{quoted[kind]}', 0), null)")
            for kind, (condition, _) in patterns.items()
        }
    )
    df = df.withColumns(
        {f"{kind}_g": F.expr(f"if(size({kind}_b) > 0, split({text}, '{quoted[kind]}', -1), null)") for kind in patterns}
    )
    df = df.withColumns(
        {
            f"{kind}_p": F.expr(
                f"transform(sequence(0, (size({kind}_b) - 1) div {BLOCK}), k -> transform("
                f"slice({kind}_b, k * {BLOCK} + 1, {BLOCK}), (b, i) -> bigint(length(b) + length({kind}_g[k * {BLOCK} + i]))))"
            )
            for kind in patterns
        }
    )
    df = df.withColumns(
        {
            f"{kind}_o": F.expr(
                _RUNNING.format(f"transform({kind}_p, p -> aggregate(p, 0L, (a, x) -> a + x))")
            )
            for kind in patterns
        }
    )
    inner = _RUNNING.format("p")
    df = df.withColumns(
        {
            f"{kind}_s": F.expr(f"flatten(transform({kind}_p, (p, k) -> transform({inner}, x -> x + {kind}_o[k])))")
            for kind in patterns
        }
    )
    return df.withColumns(
        {
            kind: F.expr(
                f"coalesce(if(size({kind}_b) > 0, transform({kind}_s, (x, i) -> named_struct("
                f"'s', x + length({kind}_g[i]), 'e', x + length({kind}_g[i]) + length({kind}_b[i]), 'body', {kind}_b[i],"
                f" 'before', right({kind}_g[i], {CONTEXT}), 'after', left({kind}_g[i + 1], 1))), null),"
                " cast(array() as array<struct<s: bigint, e: bigint, body: string, before: string, after: string>>))"
            )
            for kind in patterns
        }
    ).drop(*[f"{kind}_{part}" for kind in patterns for part in "bgpos"])


def joined(spans: str) -> Column:
    """`kind:start:end`, comma-joined, of an array of (kind, s, e) in its order."""
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.s, x.e)), ',')")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
