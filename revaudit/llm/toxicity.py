"""Toxicity by a weighted lexicon: folding, Aho-Corasick, exception phrases, normalisation by length (operator 13).

*Folding* (``folded``, built-in functions): lower case, look-alike letters of other scripts and full-width forms to Latin ones,
digits and signs that stand for letters (0 o, 1 i, 3 e, 4 a, 5 s, 7 t, 8 b, 9 g; @ a and $ s before a letter), invisible characters removed;
then the text is its words (runs of letters), with one blank around each.  Accented letters stay as they are: they are letters of
their own in many languages.

*Lexicon*: terms are whole words (3 to 40 letters) and word beginnings of 4 to 8 letters.  Their weights are learned: the lower end of the log-odds of
toxic against other texts that hold the term (``STRENGTH`` standard errors below the estimate; equal texts count once).  Only terms stay that
are among the ``TELLING`` strongest words of enough toxic texts; the others come along with stronger ones.  ``SEEDS`` have a weight
before anything is learned, and keep it unless the labelled rows say more, or show them no rarer in harmless texts.

*Exceptions*: phrases of two words, one of which is a term, in which the term does not count: ``EXCEPTIONS``, and those that the labelled rows
show to be harmless (in ``EXCEPTION_DOCS`` documents that are not toxic and, share for share, ten times as many as toxic ones).

*Score*: one automaton finds the terms and exceptions of a whole text in one run.  A word counts with the greatest weight of its terms.  The
summed weight, the summed weight per word, and the greatest weight enter a logistic curve fitted to labelled rows that
the lexicon was not learned from, with a prior, so that few rows or none give a usable score.

The labelled rows are a bounded sample: ``FIT_ROWS`` of each class, picked by a hash of the id.  The lexicon holds at most ``TERMS`` terms (the model's
size).  Scoring reads every whole text.

Nulls: a null text scores as an empty one; a null doc_id has no label and is not held out.  Null labels are ignored; several labels of
a document count as their mean.  Repeated rows are scored alike.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import held_out
from .tables import read, stored

FIT_ROWS = 8000
TERMS = 5000
#: A term needs this many toxic documents, and this weight.
TERM_DOCS, TERM_WEIGHT, STRENGTH = 3, 1.0, 1.64
TELLING = 5
EXCEPTION_DOCS = 5
SHORTEST, LONGEST = 4, 8
THRESHOLD = 0.7
SEED = 13
#: Insults known without labels, and harmless phrases of such words.
SEEDS = ("idiot", "moron", "imbecile", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
         "bastard", "bitch", "asshole", "vermin", "filthy", "retard", "whore")
SEED_WEIGHT = 2.0
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "pond scum", "class clown")
#: Logistic curve over (1, log summed weight, log summed weight per thousand words, greatest weight) before any fit.
PRIOR = (-6.0, 1.5, 1.5, 0.5)

# Look-alikes, fixed values: Cyrillic, Greek and other letters that look like the Latin letter below them.
_LOOK = "аеорсухівкмнтѕјԁԛԝɡαεορτυνκιχγıℓ∂"
_LIKE = "aeopcyxibkmhtsjdqwgaeoptuvkixyild"
_DIGITS, _DIGIT_LETTERS = "01345789", "oieastbg"
_WIDE = "".join(chr(0xFF41 + i) for i in range(26))
_LATIN = "".join(chr(97 + i) for i in range(26))
_HIDDEN = "\u200b\u200c\u200d\u2060\ufeff\u00ad"  # zero-width characters and the soft hyphen


def folded(column: str | Column) -> Column:
    """The text's folded words with one blank around each; `` `` for an empty text."""
    text = F.lower(F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")))
    text = F.translate(text, _LOOK + _DIGITS + _WIDE + _HIDDEN, _LIKE + _DIGIT_LETTERS + _LATIN)
    text = F.regexp_replace(F.regexp_replace(text, "@(?=\\p{L})", "a"), "\\$(?=\\p{L})", "s")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, "[^\\p{L}\\p{M}]+", " ")), F.lit(" "))


@dataclass
class Lexicon:
    """Terms (`` word`` begins a word, `` word `` is one) and their weights, exception phrases, the curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = PRIOR

    def automaton(self):
        import ahocorasick
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            first = phrase.index(" ")
            found.add_word(f" {phrase} ", (len(phrase) + 2, -(first + 1.0)))
        if len(found):
            found.make_automaton()
        return found

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ np.array(self.curve), -500, 500)))


def matches(automaton, text: str) -> dict[int, float]:
    """The counted words of a folded text: start -> weight.  Words inside an exception phrase do not count."""
    words: dict[int, float] = {}
    excepted: set[int] = set()
    if not len(automaton):
        return words
    for end, (size, weight) in automaton.iter(text):
        start = end - size + 1
        if weight < 0:
            excepted.update((start, start + int(-weight)))
        elif weight > words.get(start, 0.0):
            words[start] = weight
    for start in excepted:
        words.pop(start, None)
    return words


def features(automaton, text: str) -> tuple[list[float], int, int]:
    """The curve's inputs, the counted words, and all words of a folded text."""
    found = matches(automaton, text)
    n = max(0, text.count(" ") - 1) if text.strip() else 0
    total = sum(sorted(found.values()))
    return [1.0, float(np.log1p(total)), float(np.log1p(1000 * total / (n + 20))), max(found.values(), default=0.0)], len(found), n


# --- learning ------------------------------------------------------------------

def _labelled(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """folded, toxic, fits (the fold of the curve) for a bounded sample; and how many training rows each class has."""
    truth = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out()).groupBy("doc_id")
             .agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic")))
    n = {r.toxic: r["count"] for r in truth.groupBy("toxic").count().collect()}
    place = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    picked = [truth.where(F.col("toxic") == c).orderBy(place, "doc_id").limit(rows) for c in (0, 1)]
    sample = picked[0].unionAll(picked[1])
    text = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most two times ``rows`` ids
    text = text.select(folded("text").alias("folded"), "toxic").dropDuplicates(["folded", "toxic"])
    return stored(text.withColumn("fits", F.pmod(F.xxhash64("folded", F.lit(SEED)), F.lit(4)) == 0), "toxicity-sample"), n


def _learned_terms(rows: DataFrame, totals: dict[int, int]) -> dict[str, float]:
    """Terms with the lower end of their log-odds, strongest evidence first."""
    words = F.array_distinct(F.filter(F.split(F.trim("folded"), " "), lambda w: F.length(w).between(3, 40)))
    begins = F.transform(words, lambda w: F.when(F.length(w) >= SHORTEST, F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(w))), lambda k: F.concat(F.lit(" "), F.substring(w, F.lit(1), k))))
        .otherwise(F.array()))
    whole = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    terms = F.array_distinct(F.concat(whole, F.flatten(begins)))
    counts = (rows.select("toxic", F.explode(terms).alias("term")).groupBy("term")
              .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") >= TERM_DOCS))
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    odds = F.log(t / (totals.get(1, 0) + 1)) - F.log(c / (totals.get(0, 0) + 1))
    weight = odds - STRENGTH * F.sqrt(1 / t + 1 / c)
    best = (counts.select("term", "t", weight.alias("weight")).where(F.col("weight") >= TERM_WEIGHT)
            .orderBy((F.col("t") * F.col("weight")).desc(), "term").limit(TERMS).collect())
    weights: dict[str, float] = {}
    for row in sorted(best, key=lambda r: (len(r.term), r.term)):
        # A longer term says nothing new unless it weighs more than the beginnings it contains.
        shorter = max((weights.get(row.term[:k], 0.0) for k in range(2, len(row.term))), default=0.0)
        if row.weight > shorter:
            weights[row.term] = row.weight
    return weights


def _telling(rows: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """The terms that are among the strongest words of ``TERM_DOCS`` toxic texts."""
    lexicon = Lexicon(weights, ())

    def task(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            terms = []
            for text in batch.column("folded"):
                text = text.as_py()
                strongest: dict[int, tuple[float, int]] = {}
                for end, (size, weight) in automaton.iter(text) if len(automaton) else ():
                    strongest[end - size + 1] = max(strongest.get(end - size + 1, (0.0, 0)), (weight, size))
                words = {text[start:start + size]: weight for start, (weight, size) in strongest.items()}
                terms += sorted(words, key=lambda t: (-words[t], t))[:TELLING]
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string())], names=["term"])

    counts = rows.where("toxic = 1").select("folded").mapInArrow(task, "term string").groupBy("term").count()
    kept = [r.term for r in counts.where(F.col("count") >= TERM_DOCS).collect()]  # at most TERMS
    return {t: weights[t] for t in sorted(kept)}


def _seeded(weights: dict[str, float], learned: dict[str, float], rows: DataFrame, totals: dict[int, int]) -> dict[str, float]:
    """The seeds with what was learned of them or their own weight; those that are no rarer in harmless texts are left out."""
    out = dict(weights)
    unlearned = []
    for word in SEEDS:
        term = f" {word}" if len(word) >= 5 else f" {word} "
        known = [term[:k] for k in range(2, len(term) + 1) if term[:k] in learned]
        if known:
            best = max(known, key=lambda t: (learned[t], t))
            out[best] = learned[best]
        else:
            unlearned.append(term)
    if unlearned:
        seen = rows.select(*[F.sum((F.col("folded").contains(t) & (F.col("toxic") == c)).cast("int")).alias(f"s{i}_{c}")
                             for i, t in enumerate(unlearned) for c in (0, 1)]).first()
        for i, term in enumerate(unlearned):
            harmless, toxic = seen[f"s{i}_0"] or 0, seen[f"s{i}_1"] or 0
            if not harmless or harmless / (totals.get(0, 0) + 1) < toxic / (totals.get(1, 0) + 1):
                out[term] = SEED_WEIGHT
    return out


def _exceptions(rows: DataFrame, weights: dict[str, float], totals: dict[int, int]) -> tuple[str, ...]:
    """Two-word phrases with a term that stand in documents without toxicity."""
    lexicon = Lexicon(weights, EXCEPTIONS)

    def task(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            for text, toxic in zip(batch.column("folded"), batch.column("toxic").to_pylist()):
                text = text.as_py()
                phrases = set()
                for start in matches(automaton, text):
                    end = text.index(" ", start + 1)
                    if end + 1 < len(text):
                        phrases.add(text[start + 1:text.index(" ", end + 1)])
                    if start > 0:
                        phrases.add(text[text.rindex(" ", 0, start) + 1:end])
                if phrases:
                    yield pa.RecordBatch.from_arrays([pa.array(sorted(phrases)), pa.array([toxic] * len(phrases), pa.int32())],
                                                     names=["phrase", "toxic"])

    counts = (rows.select("folded", F.col("toxic").cast("int").alias("toxic")).mapInArrow(task, "phrase string, toxic int").groupBy("phrase")
              .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("c") >= EXCEPTION_DOCS))
    harmless = counts.where(F.col("c") / (totals.get(0, 0) + 1) >= 10 * (F.col("t") / (totals.get(1, 0) + 1)))
    return EXCEPTIONS + tuple(r.phrase for r in harmless.orderBy(F.desc("c"), "phrase").limit(TERMS).collect())


def _curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps towards a Gaussian prior; slopes never fall below zero."""
    prior = np.array(PRIOR)
    active = np.ones(len(prior), bool)
    while True:
        b = np.where(active, prior, 0.0)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
            gradient = x.T @ (w * (y - p)) - (b - prior) * active
            hessian = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(len(b))
            step = np.zeros(len(b))
            step[active] = np.linalg.solve(hessian[np.ix_(active, active)], gradient[active])
            size = np.abs(step).max()
            b = b + step * min(1.0, 2.0 / max(size, 1e-12))
            if size < 1e-9:
                break
        falling = active & (b < 0) & (np.arange(len(b)) > 0)
        if not falling.any():
            return tuple(b.tolist())
        active &= ~falling


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Lexicon:
    """Learn from the labelled documents that are not held out."""
    rows, classes = _labelled(docs, labels, fit_rows)
    words, curve = rows.where("NOT fits"), rows.where("fits")
    totals = {r.toxic: r["count"] for r in words.groupBy("toxic").count().collect()}
    learned = _learned_terms(words, totals)
    weights = _seeded(_telling(words, learned), learned, words, totals)
    lexicon = Lexicon(weights, _exceptions(words, weights, totals))

    def task(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            got = [features(automaton, t.as_py())[0] for t in batch.column("folded")]
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in got], pa.float64()) for k in (1, 2, 3)] + [batch.column("toxic")],
                                             names=["total", "density", "top", "toxic"])
    kept = (curve.select("folded", F.col("toxic").cast("int").alias("toxic")).mapInArrow(task, "total double, density double, top double, toxic int")
            .toPandas().sort_values(["toxic", "total", "density", "top"]))  # at most two times ``fit_rows`` rows
    y = kept["toxic"].to_numpy(float)
    share = {c: classes.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)}
    scale = len(y) / max(1, sum(classes.values()))
    x = np.concatenate([np.ones((len(kept), 1)), kept[["total", "density", "top"]].to_numpy(float)], axis=1)
    lexicon.curve = _curve(x, y, np.where(y == 1, share[1], share[0]) * scale)
    return lexicon


# --- scoring -------------------------------------------------------------------

def scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, score, n_hits (counted words), n_words of every row."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, n_hits long, n_words long"

    def task(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            got = [features(automaton, t.as_py()) for t in batch.column("folded")]
            x = np.array([g[0] for g in got]).reshape(-1, len(PRIOR))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lexicon.probability(x)), pa.array([g[1] for g in got], pa.int64()),
                                              pa.array([g[2] for g in got], pa.int64())], names=["doc_id", "score", "n_hits", "n_words"])
    return docs.select("doc_id", folded("text").alias("folded")).mapInArrow(task, schema)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return (scores(docs, learn(docs, labels)).withColumn("held_out", held_out())
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
