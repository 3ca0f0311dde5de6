"""Personal data by weak supervision, with DataFrame and SQL functions only.

Candidates are the matches of four base kinds (email, ip, card, phone) and of five looser ones. Labelers
vote for or against each candidate (+1, -1, 0): its format, gazetteers, words before it that name
or exclude its kind, its borders, and its digits. Expectation-maximisation estimates how reliable
each labeler is from the counts of vote patterns (a few thousand at most, whatever the corpus), with base
matches that pass or fail their checks held fixed; its posteriors train a logistic span classifier over
kind, votes and length. Base spans always stay; a looser candidate is added where the classifier
gives 0.5 or more and no base span overlaps it.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickermill.llm.spans import joined, sha256, with_matches
from tickermill.session import stored

BASE = ["email", "ip", "card", "phone"]
ADDED = ["obfuscated_email", "local_phone", "national_id", "iban", "person"]
KINDS = BASE + ADDED

# kind: (cheap condition, pattern). Possessive repeats and starts tied to the border of a run (or to
# the end of the last match) give the same leftmost matches in linear time.
PATTERNS = {
    "email": (
        "contains(text, '@')",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    "ip": (
        "contains(text, '.')",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    ),
    "card": (
        "true",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    ),
    "phone": (
        "contains(text, '+')",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ),
    "obfuscated_email": (
        "text rlike '(?i)[\\\\[( ](at|dot)[\\\\]) ]'",
        r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{2,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[a-z0-9-]{1,63}\x20?"
        r"(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z]{2,10}\b",
    ),
    "local_phone": (
        "true",
        r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9-])",
    ),
    "national_id": (
        "contains(text, '-')",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    ),
    "iban": (
        "true",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    ),
    "person": (
        "true",
        r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20\p{Lu}\p{Ll}{1,30}(?:\x20\p{Lu}\p{Ll}{1,30})?",
    ),
}

# Fixed values of the labelers.
ENDINGS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "it", "eu"]
COUNTRIES = ["AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"]
NAMES = ["anna", "carlos", "claire", "david", "emma", "jean", "john", "jose", "juan", "laura", "lucas", "maria",
         "marie", "martin", "mary", "michael", "paul", "peter", "pierre", "robert", "sarah", "thomas"]
NAMING = {
    "email": "e-?mail|contact|write|kontakt|correo|courriel",
    "obfuscated_email": "e-?mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|host|server|address|adresse|addr",
    "card": "card|visa|mastercard|amex|karte|carte|tarjeta|credit",
    "phone": "tel|phone|call|fax|mobile|mobil|telefon|t.l.phone|tel.fono",
    "local_phone": "tel|phone|call|fax|mobile|mobil|telefon|t.l.phone|tel.fono",
    "national_id": "ssn|social security|national id|insurance",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "person": "name|dear|signed|from|contact|patient|customer|sincerely",
}
EXCLUDING = "version|release|build|isbn|issn|order|invoice|item|part|model|serial|page|section|figure|total|price|score"


def _digits(body: str) -> str:
    return f"regexp_replace({body}, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    doubled = "2 * d - if(d > 4, 9, 0)"
    return (
        f"aggregate(transform(split(reverse({digits}), ''), c -> int(c)), named_struct('t', 0, 'i', 0),"
        f" (a, d) -> named_struct('t', a.t + if(a.i % 2 = 1, {doubled}, d), 'i', a.i + 1), a -> a.t % 10 = 0)"
    )


# Whether a match of a base kind passes its check; looser kinds have strict forms that only vote.
CHECKS = {
    "email": "true",
    "ip": "forall(split(x.body, '[.]'), p -> length(ltrim('0', p)) <= 3 and coalesce(try_cast(ltrim('0', p) as int), 0) <= 255)",
    "card": _luhn(_digits("x.body")),
    "phone": f"length({_digits('x.body')}) between 8 and 15",
    "obfuscated_email": "x.body rlike '[\\\\[(]'",
    "local_phone": "x.body rlike '^[(]|^[2-9][0-9][0-9]([-.])[0-9]+\\\\1'",
    "national_id": "not x.body rlike '^(000|666|9)|-00-|-0000$'",
    "iban": "length(replace(x.body, ' ', '')) between 15 and 34",
    "person": "x.body rlike ' .* '",
}
GAZETTEER = {
    "email": f"lower(substring_index(x.body, '.', -1)) in ({', '.join(map(repr, ENDINGS))})",
    "obfuscated_email": f"lower(regexp_extract(x.body, '([A-Za-z]+)$', 1)) in ({', '.join(map(repr, ENDINGS))})",
    "iban": f"left(x.body, 2) in ({', '.join(map(repr, COUNTRIES))})",
    "person": f"exists(split(lower(x.body), ' '), p -> p in ({', '.join(map(repr, NAMES))}))",
}
LABELERS = ["format", "gazetteer", "naming", "excluding", "border", "digits"]
ROUNDS, STEPS, DECAY = 30, 400, 1e-3
ACCEPT = 0.5


def _votes(kind: str) -> str:
    """named_struct of one candidate x: kind, place, check, labeler votes and length class."""
    check = CHECKS[kind]
    votes = {
        "format": f"if({check}, 1, -1)",
        "gazetteer": f"if({GAZETTEER[kind]}, 1, 0)" if kind in GAZETTEER else "0",
        "naming": f"if(lower(x.before) rlike '(^|[^a-z])({NAMING[kind]})[^a-z]', 1, 0)",
        "excluding": f"if(lower(x.before) rlike '(^|[^a-z])({EXCLUDING})[^a-z]*$', -1, 0)",
        "border": "if(x.after rlike '[A-Za-z0-9]' or right(x.before, 1) rlike '[A-Za-z0-9]', -1, 1)",
        "digits": "if(x.body rlike '([0-9])[^0-9]*(\\\\1[^0-9]*){6,}', -1, 0)",
    }
    fields = ", ".join(f"'{name}', {vote}" for name, vote in votes.items())
    return (
        f"transform({kind}, x -> named_struct('kind', '{kind}', 's', x.s, 'e', x.e, 'pass', {check}, {fields},"
        " 'size', least(3, length(x.body) div 12)))"
    )


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, found): all candidates of a text in the order of KINDS, then by place."""
    own = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    matched = with_matches(own, "text", PATTERNS)
    return matched.select("doc_id", F.concat(*[F.expr(_votes(kind)) for kind in KINDS]).alias("found"))


def estimate(patterns: list[dict]) -> list[float]:
    """P(personal data) of every vote pattern (with its count n) by expectation-maximisation.

    Votes are independent given the truth; each labeler has a distribution of votes for true and for
    false candidates, each kind a share of true ones. Base patterns keep the truth of their check.
    """
    fixed = np.array([float(p["pass"]) if p["kind"] in BASE else np.nan for p in patterns])
    n = np.array([p["n"] for p in patterns], float)
    votes = np.array([[p[x] for x in LABELERS] for p in patterns]) + 1
    kind = np.array([KINDS.index(p["kind"]) for p in patterns])
    belief = np.where(np.isnan(fixed), 1 / (1 + np.exp(-(votes - 1).sum(axis=1))), fixed)
    for _ in range(ROUNDS):
        logit = np.zeros(len(patterns))
        for side, weight in ((1, n * belief), (-1, n * (1 - belief))):
            share = np.bincount(kind, weight, len(KINDS)) + 1
            logit += side * np.log(share)[kind]
            for k in range(len(LABELERS)):
                seen = np.bincount(votes[:, k], weight, 3) + 1
                logit += side * np.log(seen / seen.sum())[votes[:, k]]
        belief = np.where(np.isnan(fixed), 1 / (1 + np.exp(-np.clip(logit, -50, 50))), fixed)
    return belief.tolist()


def _indicators(kind, votes, size) -> list[float]:
    return (
        [1.0]
        + [float(kind == k) for k in KINDS]
        + [float(v == 1) for v in votes]
        + [float(v == -1) for v in votes]
        + [float(size == s) for s in (1, 2, 3)]
    )


def train(patterns: list[dict], belief: list[float]) -> list[float]:
    """Weights of the logistic span classifier, fitted to the posteriors with their counts."""
    x = np.array([_indicators(p["kind"], [p[v] for v in LABELERS], p["size"]) for p in patterns])
    n = np.array([p["n"] for p in patterns], float)
    weight = np.sqrt(n) / np.sqrt(n).sum()  # frequent patterns do not drown the others
    beta = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        beta -= 4.0 * (x.T @ (weight * (p - np.array(belief))) + DECAY * beta)
    return beta.tolist()


def _probability(beta: list[float]) -> str:
    """SQL of the classifier for a candidate x."""
    names = (
        ["true"]
        + [f"x.kind = '{k}'" for k in KINDS]
        + [f"x.{v} = 1" for v in LABELERS]
        + [f"x.{v} = -1" for v in LABELERS]
        + [f"x.size = {s}" for s in (1, 2, 3)]
    )
    terms = [f"if({name}, {weight!r}D, 0D)" for name, weight in zip(names, beta) if weight and math.isfinite(weight)]
    return f"1 / (1 + exp(-({' + '.join(terms) or '0D'})))"


def label(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, base and all_spans, arrays of (kind, s, e) in code points.

    Null and empty texts have no spans; repeated rows give equal ones. Without any candidate in the
    whole table nothing is learned and nothing added. Other columns are ignored.
    """
    found = stored(candidates(docs, id_column, text_column), "candidates")
    keys = ["kind", "pass", *LABELERS, "size"]
    seen = found.select(F.explode("found").alias("x")).select("x.*").groupBy(*keys).agg(F.count("*").alias("n"))
    patterns = [row.asDict() for row in seen.orderBy(*keys).collect()]  # kinds x 2 x 3^6 x 4 at most
    beta = train(patterns, estimate(patterns)) if patterns else []
    base = ", ".join(map(repr, BASE))
    place = "x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e)"
    out = found.withColumn("base", F.expr(f"transform(filter(found, x -> x.kind in ({base}) and x.pass), {place})"))
    added = (
        f"transform(filter(found, x -> not x.kind in ({base}) and {_probability(beta)} >= {ACCEPT}"
        f" and not exists(base, b -> b.s < x.e and x.s < b.e)), {place})"
    )
    return out.select("doc_id", "base", F.concat("base", F.expr(added)).alias("all_spans"))


def _count(kind: str) -> Column:
    return F.expr(f"bigint(size(filter(base, x -> x.kind = '{kind}')))").alias(f"n_{kind}")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, counts of the base kinds, base_sha256 and spans (see `label`)."""
    own = label(docs, id_column, text_column)
    return own.select(
        "doc_id", *[_count(kind) for kind in BASE], sha256(joined("base")).alias("base_sha256"), joined("all_spans").alias("spans")
    )
