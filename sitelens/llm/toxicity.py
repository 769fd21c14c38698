"""Toxicity by weak supervision.

1. Voters.  From a bounded sample of labelled rows (``SAMPLE`` a class, by hash
   of the id) Spark counts in how many toxic and clean texts each word and word
   prefix occurs.  The terms with the strongest association form the lexicon; the
   first of them and a few patterns are the voters.
2. Label model.  Every document's votes are counted by vote pattern.  EM over all
   patterns estimates the class prior and, per voter, how often it fires on
   either class.  The voters' correlations within the classes, from the same
   counts, shrink the weight of voters that say the same thing.
3. Classifier.  A logistic regression on the whole lexicon and the patterns is
   trained on the sample's posterior labels and scores every whole text.

Labels are read only from rows outside the held-out fold.  Language, source and
id are no inputs of a score.

Defined cases: null text is the empty text; a ``doc_id`` labelled more than once
is toxic if any row says so; null labels and ids teach nothing, rows without id
are scored and not held out; without toxic or without clean labels every score
is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

#: Labelled rows a class that the voters and the classifier learn from, at most.
SAMPLE = 4000
#: FEWEST: terms taken even if a sample is too small to tell them from chance.
LEXICON, LEXICON_VOTERS, FEWEST = 512, 48, 8
#: Contexts that a worker holds before it passes them on.
CONTEXTS = 100_000
PREFIXES = (4, 5, 6)
FOLDS, HELD_OUT = 5, 0
STRIP = ".,;:!?\"'()[]{}<>*_-"
PATTERNS = ("shout", "bangs", "repeats", "one_term", "two_terms", "dense_terms")


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


@dataclass
class Model:
    """The lexicon, the label model and the classifier."""
    terms: dict[str, int] = field(default_factory=dict)
    heads: frozenset[str] = frozenset()
    prior: float = 0.0
    weights: np.ndarray | None = None
    bias: float = 0.0

    def profile(self, text: str | None) -> tuple[list[int], list[float]]:
        """Lexicon terms that occur, and the strength of each pattern."""
        text = text or ""
        words = text.lower().split()
        terms, heads, found, hits = self.terms, self.heads, set(), 0
        distinct = set(words)
        for word in distinct:
            word = word.strip(STRIP)
            if word[:PREFIXES[0]] in heads:
                here = [terms[t] for t in _terms_of(word) if t in terms]
                if here:
                    hits += 1
                    found.update(here)
        upper = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")) if text.isupper() else 0
        return sorted(found), [float(upper > 20), float(text.count("!!") >= 3),
                               float(len(words) > 20 and len(distinct) < len(words) / 4),
                               float(hits >= 1), float(hits >= 2), float(hits * 100 >= len(words) > 0)]

    def mask(self, text: str | None) -> int:
        """Fired voters as bits: lexicon terms first, then the patterns."""
        found, patterns = self.profile(text)
        voters = min(len(self.terms), LEXICON_VOTERS)
        return (sum(1 << t for t in found if t < voters)
                + sum(1 << (voters + k) for k, on in enumerate(patterns) if on))

    def row(self, text: str | None) -> np.ndarray:
        found, patterns = self.profile(text)
        x = np.zeros(len(self.terms) + len(PATTERNS), np.float32)
        x[found] = 1
        x[len(self.terms):] = patterns
        return x

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.prior
        found, patterns = self.profile(text)
        z = self.bias + self.weights[found].sum() + self.weights[len(self.terms):] @ patterns
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _terms_of(word: str) -> list[str]:
    """A word as itself (marked) and by its prefixes."""
    return ["=" + word, *(word[:n] for n in PREFIXES if len(word) > n)]


def _terms_column(word: str) -> Column:
    """``_terms_of`` as a column."""
    prefixes = [F.when(F.char_length(word) > n, F.substring(word, 1, n)) for n in PREFIXES]
    return F.array_compact(F.array(F.concat(F.lit("="), F.col(word)), *prefixes))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``SAMPLE`` ids a class, from the learning folds."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    parts = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE) for y in (0, 1)]
    chosen = materialize(parts[0].union(parts[1]).select("doc_id", "toxic"), "toxicity-ids")
    # bounded by 2 * SAMPLE ids
    return materialize(docs.select("doc_id", text_or_empty().alias("text"))
                       .join(F.broadcast(chosen), "doc_id"), "toxicity-sample")


def learn_lexicon(sample: DataFrame) -> list[str]:
    """The terms most associated with toxic rows, strongest first."""
    def terms(batches):
        for pdf in batches:
            out = [(t, y) for text, y in zip(pdf["text"], pdf["toxic"], strict=True)
                   for t in {t for w in set(text.lower().split()) for t in _terms_of(w.strip(STRIP))}]
            yield pd.DataFrame(out, columns=["term", "toxic"])

    totals = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    counts = (sample.mapInPandas(terms, "term string, toxic int").where("term <> '='").groupBy("term")
              .agg(F.sum("toxic").alias("k1"), F.sum(1 - F.col("toxic")).alias("k0")))
    tried = materialize(counts.where("k1 > 0"), "toxicity-terms")
    base = n1 / (n1 + n0)

    # copies of one toxic text repeat all its words: what counts is the number of
    # different words that a term follows
    def contexts(batches):
        for pdf in batches:
            out = set()
            for text, y in zip(pdf["text"], pdf["toxic"], strict=True):
                before = ""
                for w in text.lower().split():
                    out.add((w.strip(STRIP), before, y))
                    before = w
                if len(out) >= CONTEXTS:
                    yield pd.DataFrame(list(out), columns=["word", "before", "toxic"])
                    out = set()
            yield pd.DataFrame(list(out), columns=["word", "before", "toxic"])

    seen = (sample.mapInPandas(contexts, "word string, before string, toxic int")
            .select(F.explode(_terms_column("word")).alias("term"), "before", "toxic").distinct())
    counts = seen.groupBy("term").agg(F.sum("toxic").alias("k1"), F.sum(1 - F.col("toxic")).alias("k0"))
    counts = counts.where("k1 > 0").join(_associated(tried, base).select("term"), "term", "left_semi")
    ranked = _strongest(counts, base).limit(4 * LEXICON).collect()
    chance = 2 * np.log(max(tried.count(), 2))
    chosen: dict[str, int] = {}
    for r in ranked:
        word = r.term.lstrip("=")
        within = any(word[:n] in chosen for n in PREFIXES if n <= len(word))
        same = any(k1 == r.k1 and c.lstrip("=").startswith(word) for c, k1 in chosen.items())
        # a longer form of a chosen prefix, or a prefix that meets the same rows, adds nothing
        if not within and not same and (r.strength > chance or len(chosen) < FEWEST):
            chosen[r.term] = r.k1
    return list(chosen)[:LEXICON]


def _associated(counts: DataFrame, base: float) -> DataFrame:
    return counts.where(F.col("k1") > 4 * base / (1 - base) * F.col("k0"))


def _strongest(counts: DataFrame, base: float) -> DataFrame:
    """Terms by the likelihood ratio of "toxic rows have it more often than clean ones"."""
    n = F.col("k1") + F.col("k0")
    ratio = 2 * (F.col("k1") * F.log(F.col("k1") / (n * base))
                 + F.when(F.col("k0") > 0, F.col("k0") * F.log(F.col("k0") / (n * (1 - base)))).otherwise(0.0))
    return (_associated(counts.withColumn("strength", ratio), base)
            .orderBy(F.desc("strength"), F.desc(F.length("term")), "term"))


def _voting(masks: np.ndarray, voters: int) -> np.ndarray:
    return ((masks[:, None] >> np.arange(voters)) & 1).astype(np.float64)


def fit_label_model(patterns: DataFrame, start: tuple[float, np.ndarray, np.ndarray], rounds: int = 8):
    """Prior, firing rates on toxic and clean, and weights by EM over ``(mask, n)``.

    Each round is one aggregation over the patterns of the whole corpus."""
    prior, on1, on0 = start
    voters = len(on1)
    shrink = np.ones(voters)
    for _ in range(rounds):
        bias, weight = _log_odds(prior, on1, on0, shrink)

        def moments(batches, bias=bias, weight=weight):
            total = np.zeros((2, voters + 1, voters + 1))
            for pdf in batches:
                x = _voting(pdf["mask"].to_numpy(np.int64), voters)
                post = 1 / (1 + np.exp(-np.clip(bias + x @ weight, -30, 30)))
                x = np.hstack([x, np.ones((len(x), 1))])
                for y, share in enumerate((1 - post, post)):
                    total[y] += (x * (share * pdf["n"].to_numpy())[:, None]).T @ x
            y, i, j = np.nonzero(total)
            yield pd.DataFrame({"y": y, "i": i, "j": j, "n": total[y, i, j]})

        sums = patterns.mapInPandas(moments, "y int, i int, j int, n double").groupBy("y", "i", "j").agg(F.sum("n").alias("n"))
        m = np.zeros((2, voters + 1, voters + 1))
        for r in sums.collect():                       # 2 * (voters + 1)^2 numbers
            m[r.y, r.i, r.j] = r.n
        size = np.maximum(m[:, voters, voters], 1e-9)
        prior = float(np.clip(size[1] / size.sum(), 1e-4, 0.9))
        on0, on1 = (np.clip((np.diag(m[y])[:voters] + 0.05) / (size[y] + 0.1), 1e-5, 1 - 1e-5) for y in (0, 1))
        # within the classes, voters that fire together share their weight
        together = np.zeros((voters, voters))
        for y, on in ((0, on0), (1, on1)):
            spread = np.sqrt(on * (1 - on))
            rho = (m[y, :voters, :voters] / size[y] - np.outer(on, on)) / np.outer(spread, spread)
            together = np.maximum(together, np.clip(rho, 0, 1))
        np.fill_diagonal(together, 0)
        together[together < 0.1] = 0
        shrink = 1 / (1 + together.sum(axis=1))
    return prior, on1, on0, shrink


def _log_odds(prior, on1, on0, shrink):
    silent = np.log((1 - on1) / (1 - on0)) * shrink
    fired = np.log(on1 / on0) * shrink
    return float(np.log(prior / (1 - prior)) + silent.sum()), fired - silent


def _logistic(x: np.ndarray, y: np.ndarray, sample_weight: np.ndarray, penalty: float = 1.0, steps: int = 60):
    """Ridge logistic regression on soft labels by Newton steps; the bias is free."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (sample_weight * (p - y)) + ridge * beta
        curve = np.maximum(sample_weight * p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + np.diag(ridge), gradient)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-9))
        beta -= step
        if np.abs(step).max() < 1e-5:
            break
    return beta[:-1], float(beta[-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = labelled_sample(docs, labels)
    terms = learn_lexicon(sample)
    model = Model({t: i for i, t in enumerate(terms)},
                  frozenset(t.lstrip("=")[:PREFIXES[0]] for t in terms))
    counts = {r.toxic: r["count"] for r in labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("toxic").count().collect()}
    model.prior = counts.get(1, 0) / sum(counts.values()) if len(counts) > 1 else 0.0
    if not terms:
        return model
    voters = min(len(terms), LEXICON_VOTERS) + len(PATTERNS)
    patterns = materialize(docs.select(_masks(model)(text_or_empty()).alias("mask")).groupBy("mask")
                           .agg(F.count(F.lit(1)).alias("n")), "toxicity-votes")
    rows = sample.mapInPandas(_features(model), "toxic int, mask bigint, x binary").toPandas()  # 2 * SAMPLE rows
    y = rows["toxic"].to_numpy(float)
    x = np.stack([np.frombuffer(b, np.float32) for b in rows["x"]])
    votes = _voting(rows["mask"].to_numpy(np.int64), voters)
    on1, on0 = ((votes[y == c].sum(axis=0) + 0.5) / ((y == c).sum() + 1) for c in (1, 0))
    prior, on1, on0, shrink = fit_label_model(patterns, (min(max(model.prior, 1e-3), 0.9), on1, on0))
    bias, weight = _log_odds(prior, on1, on0, shrink)
    # the label of a sample row is one more, trusted voter
    gold = np.where(y == 1, 3.0, -3.0)
    posterior = 1 / (1 + np.exp(-np.clip(bias + votes @ weight + gold, -30, 30)))
    share = np.where(y == 1, model.prior / max((y == 1).mean(), 1e-9), (1 - model.prior) / max((y == 0).mean(), 1e-9))
    model.weights, model.bias = _logistic(x, posterior, share)
    return model


def _masks(model: Model):
    @F.pandas_udf("bigint")
    def masks(texts: pd.Series) -> pd.Series:
        return pd.Series([model.mask(t) for t in texts], dtype="int64")
    return masks


def _features(model: Model):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"toxic": pdf["toxic"], "mask": [model.mask(t) for t in pdf["text"]],
                                "x": [model.row(t).tobytes() for t in pdf["text"]]})
    return run


def scorer(model: Model):
    """Score of a text as a column function."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")
    return score


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    score = scorer(fit(docs, labels))
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), score(text_or_empty()).alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject."""
    return docs.where(scorer(fit(docs, labels))(text_or_empty()) < 0.5)
