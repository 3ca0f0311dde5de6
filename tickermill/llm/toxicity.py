"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features: densities of a fixed and of a learned lexicon, second-person pronouns near lexicon words,
capitals, punctuation, and rates of obfuscated words (letters mixed with digits or signs, stretched
letters) with the lexicon words they hide. The learned lexicon holds the words and word beginnings of
3 to 8 letters that are far more frequent in toxic than in other documents, from a sample of at most
SAMPLE documents of each label. The features of every document are computed once and stored; trees
(two of three learning folds) and calibration (the third) learn from all labelled documents in Spark.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickermill.llm import language, training
from tickermill.session import stored

SAMPLE, TERMS = 3000, 2000
MIN_SHARE, MIN_COUNT, MIN_RATIO = 0.02, 4, 10.0
STEMS = range(3, 9)
NEAR = 5
ACCEPT = 0.3

# Common insults and second-person words.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers trash garbage pathetic disgusting worthless scum clown "
    "fool fools freak creep pig jerk imbecile retard vermin filth coward liar shut hate kill idiota estúpido "
    "imbécil basura asqueroso inútil payaso escoria idiote stupide crétin ordure minable dégoûtant salaud débile "
    "dumm dummkopf trottel abschaum widerlich wertlos versager depp arschloch".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself ur u du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split()
)
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!.*_-]+[^\W\d_]+)+")
_SIGN = np.zeros(256, np.int64)
_SIGN[[ord(c) for c in "0123456789@$!.*_-"]] = 1

FEATURES = [
    "fixed_density", "fixed_any", "learned_density", "learned_count", "learned_any", "second_person",
    "second_person_near", "capitals", "capital_runs", "exclamations", "punctuation", "mixed_words",
    "hidden_words", "stretched_letters", "log_words",
]


def forms(word: str):
    """The lexicon terms a lower-case word can match: itself and its beginnings, marked by a star."""
    yield word
    for size in STEMS:
        if len(word) > size:
            yield word[:size] + "*"


class Lexicon:
    """Whole words and stems by length, from terms as `forms` writes them."""

    def __init__(self, terms: frozenset[str]):
        self.words = {t for t in terms if t[-1] != "*"}
        self.stems = {n: {t[:-1] for t in terms if t[-1] == "*" and len(t) == n + 1} for n in STEMS}
        self.stems = {n: stems for n, stems in self.stems.items() if stems}

    def __contains__(self, word: str) -> bool:
        return word in self.words or any(len(word) > n and word[:n] in stems for n, stems in self.stems.items())


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Dense features of a text, in the order of FEATURES; zeros for null, empty or wordless texts."""
    if not text:
        return [0.0] * len(FEATURES)
    lower = text.lower()
    found = _WORD.findall(lower)
    if not found:
        return [0.0] * len(FEATURES)
    count = len(found)
    fixed_words = INSULTS.intersection(found)
    learned_words = {w for w in set(found) if w in lexicon}
    marked = fixed_words | learned_words
    bad = [k for k, w in enumerate(found) if w in marked] if marked else []
    fixed = sum(found[k] in fixed_words for k in bad)
    own = sum(found[k] in learned_words for k in bad)
    addressed = SECOND_PERSON.intersection(found)
    second = np.array([k for k, w in enumerate(found) if w in addressed] if addressed else [])
    near = 0
    if bad and len(second):
        at = np.searchsorted(second, bad)
        gap = np.minimum(
            np.abs(second[np.minimum(at, len(second) - 1)] - bad), np.abs(second[np.maximum(at - 1, 0)] - bad)
        )
        near = int((gap <= NEAR).sum())
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = language.letters()[codes]
    small = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
    upper = codes != small if len(small) == len(codes) else np.array([c.isupper() for c in text])
    letters = max(1, np.count_nonzero(letter))
    runs = np.count_nonzero(upper[1:] & upper[:-1])
    same = codes[1:] == codes[:-1]
    stretched = np.count_nonzero(same[1:] & same[:-1] & letter[2:])
    # Letters, then signs or digits, then letters: only such texts are searched for hidden words.
    kind = np.where(letter, 1, 2 * _SIGN[np.minimum(codes, 255)] * (codes < 256))
    kind = kind[np.concatenate([[True], kind[1:] != kind[:-1]])]
    mixed = _MIXED.findall(lower) if ((kind[:-2] == 1) & (kind[1:-1] == 2) & (kind[2:] == 1)).any() else []
    hidden = 0
    for word in mixed:
        plain = "".join(_WORD.findall(word.translate(SIGNS)))
        hidden += plain in INSULTS or plain in lexicon
    signs = np.count_nonzero(~letter & (codes != 32))
    return [
        fixed / count, float(fixed > 0), own / count, float(own), float(own > 0), len(second) / count,
        near / count, np.count_nonzero(upper) / letters, runs / letters, (text.count("!") + text.count("?")) / count,
        signs / len(text), len(mixed) / count, hidden / count, stretched / count, float(np.log1p(count)),
    ]


def learn_lexicon(docs: DataFrame, known: DataFrame) -> frozenset[str]:
    """Terms of the labelled sample that mark toxic documents; TERMS at most.

    Documents with equal texts count once, and a term has to be in 2 % of the toxic ones, so a passage
    that a few copies share does not become part of the lexicon.
    """
    ids = training.sample(known, "label", SAMPLE)

    @F.pandas_udf("array<string>")
    def terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({f for w in set(_WORD.findall(t.lower())) for f in forms(w)}) for t in texts], dtype=object)

    chosen = docs.where("text is not null").join(F.broadcast(ids), "doc_id").withColumn("body", F.xxhash64("text"))
    chosen = chosen.dropDuplicates(["label", "body"]).select("label", terms("text").alias("terms"))
    chosen = stored(chosen, "terms")
    total = {r.label: r.n for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return frozenset()
    counts = chosen.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("n")
    )
    share, other = F.col("toxic") / total[1], (F.col("n") - F.col("toxic") + 0.5) / total[0]
    marked = counts.where((share >= MIN_SHARE) & (F.col("toxic") >= MIN_COUNT) & (share / other >= MIN_RATIO))
    best = marked.orderBy((share * F.log(share / other)).desc(), "term").limit(TERMS)
    return frozenset(r.term for r in best.select("term").collect())


def scores(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", folds: int = 4, held_out: int = 2) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score (0 to 1) and predicted (1 from 0.3 on).

    Null and empty texts have features of zero and are scored like other texts. If the labels to learn
    from are of one kind or missing, every score is the share of label 1 among them (0 without any).
    Repeated rows get equal scores; a null doc_id is neither held out nor learned from. Only doc_id and
    text of `docs` are read.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = training.one_label(labels, label_column).where(training.fold(F.col("doc_id"), folds) != held_out)
    lexicon = docs.sparkSession.sparkContext.broadcast(Lexicon(learn_lexicon(own, known)))

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, lexicon.value) for t in texts], dtype=object)

    found = stored(own.select("doc_id", dense("text").alias("features")), "features")
    every = found.select("doc_id", array_to_vector("features").alias("features"))
    is_out = F.coalesce(training.fold(F.col("doc_id"), folds) == held_out, F.lit(False))
    scored = _trained(every, known, folds, held_out)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))
    out = scored.select("doc_id", is_out.alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def _trained(every: DataFrame, known: DataFrame, folds: int, held_out: int) -> DataFrame:
    rows = stored(every.join(known, "doc_id").withColumn("label", F.col("label").cast("double")), "labelled")
    last = max(k for k in range(folds) if k != held_out)
    calibrating = F.coalesce(training.fold(F.col("doc_id"), folds) == last, F.lit(False))
    counts = {(r.c, r.label): r.n for r in rows.groupBy(calibrating.alias("c"), "label").agg(F.count("*").alias("n")).collect()}
    toxic, total = sum(n for (_, y), n in counts.items() if y == 1), sum(counts.values())
    if not counts.get((False, 0.0)) or not counts.get((False, 1.0)):
        return every.withColumn("score", F.lit(toxic / total if total else 0.0))
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.3, seed=7, cacheNodeIds=False
    ).fit(rows.where(~calibrating))
    chance = vector_to_array("probability")[1]
    out = trees.transform(every).withColumn("raw", chance)
    if not counts.get((True, 0.0)) or not counts.get((True, 1.0)):
        return out.withColumn("score", F.col("raw"))
    held = trees.transform(rows.where(calibrating)).withColumn("raw", chance)
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(held.select("raw", "label"))
    return isotonic.transform(out.select("doc_id", "raw"))
