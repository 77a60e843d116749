"""Mixing sources to target weights by soft domain membership (DataFrame functions only).

Classifier: multinomial naive Bayes over hashed words, counted over a bounded sample of
the labelled table (``LABELLED`` rows with the smallest id hashes; its ids are broadcast,
so no text is shuffled).  Posteriors: every whole text is cut into words, each word adds
its bucket's log weights, one partial aggregate per document; tempered scores become
probabilities over domains.

A second classifier (``fit_words``) reads only the words whose presence differs clearly between
the domains of the labelled rows, at most ``MOST_WORDS`` of them; a word counts once per text.

Rates: document rates x, not below a lower bound (0, or 1 where ``floor`` holds), solve  min |sum_d x_d n_d p_d - t|^2  (n: tokens, p:
posteriors, t: target tokens per domain) by projected gradient steps from x = 1.  In the
metric that weighs a document by its tokens a step changes x_d by -p_d . s and projects, where s is the
residual (one number per domain) scaled by the inverse of the Gram matrix  sum_d n_d p_d p_d'  of
the documents that it moves (not at their bound, or pulled away from it): while none reaches it, one step
meets the targets, so a few steps do.  A step that brings the totals no nearer is halved, then
replaced by the unscaled one.  A document's rate after t steps is a fold of t
small vectors over its posteriors: a step is one narrow aggregate over the staged
posteriors and returns a few sums; no rates are shuffled or collected.

Defined results: every row is a document of its own, whatever ids there are (a null id is an id, equal rows get
equal rates); a null or empty text has no tokens and the prior posteriors; domains
without labelled rows or tokens cannot be filled and keep their residual (``fit_words`` leaves
them out); targets that are not met are logged as a warning with the totals reached; without
labelled rows the posteriors are uniform; an empty table gives an empty table; other columns pass
through, whatever their names.
"""

from __future__ import annotations

import json
import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.common import let, once, stage, words_expr

BUCKETS = 1 << 13
LABELLED = 5000        # labelled rows that the classifier is fitted on, at most
TEMPERATURE = 4.0
TOLERANCE = 5e-4       # of the target total
LEAST_GAIN = 0.01      # by which a step brings the totals nearer to the targets
HALVINGS = 4           # of a scaled step that does not, before the plain one
RIDGE = 1e-6
LEAST_DOCS = 10        # labelled rows that hold a word of the second classifier, at least
LEAST_Z = 3.0          # standard errors by which its log odds differ from zero, at least
MOST_WORDS = 512

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    prior: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]   # per domain, per bucket


def bucket(word: Column, n: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.lower(word)), F.lit(n)).cast("int")


def fit_domains(docs: DataFrame, labelled: DataFrame, domains, key: str = "doc_id", text: str = "text",
                most: int = LABELLED, smooth: float = 1.0) -> DomainModel:
    """Naive Bayes from ``labelled`` (key, domain) and the documents' texts."""
    chosen = (labelled.select(F.col(f"`{key}`").alias("_k"), F.col("domain").alias("_domain"))
              .where(F.col("_domain").isin(*domains)).dropDuplicates(["_k"])
              .orderBy(F.xxhash64("_k"), "_k").limit(most))
    seen = labelled_texts(docs, chosen, key, text)
    counted = (seen.select("_domain", F.explode_outer(words_expr(F.col("_t"))).alias("w"))
               .groupBy("_domain", bucket(F.col("w")).alias("b")).agg(F.count("w").alias("n")).collect())
    shares = {r["_domain"]: r["n"] for r in chosen.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros((len(domains), BUCKETS))
    for r in counted:
        if r["b"] is not None:
            counts[domains.index(r["_domain"]), r["b"]] += r["n"]
    prior = np.array([shares.get(d, 0) + 1.0 for d in domains])
    p = (counts + smooth) / (counts + smooth).sum(axis=1, keepdims=True)
    w = np.log(p)
    w -= w.mean(axis=0)      # only differences between domains count
    return DomainModel(tuple(domains), tuple(prior / prior.sum()), tuple(tuple(np.round(r, 5)) for r in w))


def labelled_texts(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """(_k, _domain, _t): one text per chosen id, that of the smallest hash where an id has several.

    ``chosen`` holds a bounded number of ids and names, so that it is broadcast.
    """
    seen = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t")).join(F.broadcast(chosen), "_k")
    return seen.groupBy("_k", "_domain").agg(F.min_by("_t", F.xxhash64("_t")).alias("_t"))


@dataclass(frozen=True)
class WordModel:
    domains: tuple[str, ...]
    prior: tuple[float, ...]
    words: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]   # per domain, per word


def fit_words(docs: DataFrame, labelled: DataFrame, domains, key: str = "doc_id", text: str = "text",
              most: int = LABELLED) -> WordModel:
    """Presence of telling words, from ``labelled`` (key, domain) rows among the documents.

    The model's domains are those of ``domains`` that the documents' labelled rows hold (all
    of them if there are none).
    """
    ids = docs.select(F.col(f"`{key}`").alias("_k")).distinct()
    chosen = stage(labelled.select(F.col(f"`{key}`").alias("_k"), F.col("domain").alias("_domain"))
                   .where(F.col("_domain").isin(*domains)).dropDuplicates(["_k"]).join(ids, "_k", "left_semi")
                   .orderBy(F.xxhash64("_k"), "_k").limit(most), "labelled")
    seen = labelled_texts(docs, chosen, key, text)
    held = {r["_domain"]: r["n"] for r in chosen.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    own = [d for d in domains if d in held] or list(domains)
    rows = [float(held.get(d, 0)) for d in own]
    prior = np.array(rows) + 1.0
    c = [F.col(f"c{i}") for i in range(len(own))]
    counted = (seen.select("_domain", F.explode(F.array_distinct(words_expr(F.lower("_t")))).alias("w"))
               .groupBy("w").agg(*[F.count(F.when(F.col("_domain") == d, 1)).cast("double").alias(f"c{i}")
                                   for i, d in enumerate(own)]))
    every = sum(c[1:], c[0])

    def z(i):
        rest = every - c[i]
        odds = F.log((c[i] + 0.5) / F.lit(rows[i] + 1) / ((rest + 0.5) / F.lit(sum(rows) - rows[i] + 1)))
        return F.abs(odds) / F.sqrt(1 / (c[i] + 0.5) + 1 / (rest + 0.5))

    scores = [z(i) for i in range(len(own))]
    found = (counted.where(every >= LEAST_DOCS)
             .withColumn("z", F.greatest(*scores) if len(own) > 1 else F.lit(0.0)).where(F.col("z") >= LEAST_Z)
             .orderBy(F.desc("z"), "w").limit(MOST_WORDS).collect())
    w = np.log((np.array([[r[f"c{i}"] for r in found] for i in range(len(own))]) + 0.5)
               / (np.array(rows)[:, None] + 1))
    w -= w.mean(axis=0)      # only differences between domains count
    return WordModel(tuple(own), tuple(prior / prior.sum()), tuple(r["w"] for r in found),
                     tuple(tuple(np.round(r, 5)) for r in w))


def literal_doubles(values) -> Column:
    """A constant array column, folded once by the optimizer."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def total(places: Column, weights: Column) -> Column:
    """Sum of the weights at the given places; a place that the weights lack adds nothing."""
    return F.aggregate(places, F.lit(0.0), lambda a, j: a + F.coalesce(F.get(weights, j), F.lit(0.0)))


def bucket_sums(text: Column, model: DomainModel) -> Column:
    """(n, sums): every word adds its bucket's weights."""
    return let(F.transform(words_expr(text), lambda w: bucket(w)), lambda at: F.struct(
        F.size(at).cast("long").alias("n"),
        F.array(*[total(at, literal_doubles(w)) for w in model.weights]).alias("sums")))


def word_sums(text: Column, model: WordModel) -> Column:
    """(n, sums): every telling word that a text holds adds its weights."""
    # words hold no space, so that one literal splits into them
    known = F.split(F.lit(" ".join(model.words)), " ")
    tables = [literal_doubles(w) if model.words else F.array().cast("array<double>") for w in model.weights]

    def found(w):
        return F.transform(F.array_intersect(w, known), lambda x: F.array_position(known, x).cast("int") - 1)

    return let(words_expr(F.lower(text)), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), let(found(w), lambda at: F.array(*[total(at, t) for t in tables])).alias("sums")))


def posteriors(df: DataFrame, model: DomainModel | WordModel, text: str = "text",
               temperature: float = TEMPERATURE) -> DataFrame:
    """(in_0, in_1, .., n_tokens, p): every row's own columns by position, its tokens, each domain's probability."""
    rows = df.select(*[F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(df.columns)])
    body = F.col(f"in_{df.columns.index(text)}")
    rows = once(rows, "s", (word_sums if isinstance(model, WordModel) else bucket_sums)(body, model))
    logit = F.transform("s.sums", lambda v, i: v / F.lit(temperature) + F.get(literal_doubles(
        [math.log(x) for x in model.prior]), i))
    odds = let(logit, lambda v: F.transform(v, lambda x: F.exp(x - F.array_max(v))))
    p = let(odds, lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda a, y: a + y)))
    own = [c for c in rows.columns if c != "s"]
    rows = once(rows, "p", p)
    return rows.select(*own, F.col("s.n").alias("n_tokens"), "p")


def fold_rate(p: Column, steps: list[list[float]], k: int, low: Column | None = None) -> Column:
    """Rate after the given steps, from 1; a step is a scaled residual per domain.

    ``low`` is the rate's lower bound, 0 or 1 (0 if not given).
    """
    if not steps:
        return F.lit(1.0)
    # one folded literal, so that every iteration runs the same generated code
    given = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")

    def step(x, e):
        move = sum((F.get(p, i) * F.get(e, i) for i in range(1, k)), F.get(p, 0) * F.get(e, 0))
        return F.greatest(x - move, F.lit(0.0) if low is None else low)

    return F.aggregate(given, F.lit(1.0), step)


def fit_rates(table: DataFrame, shares, budget: float = 1.0, tolerance: float = TOLERANCE,
              low: Column | None = None) -> tuple[list[list[float]], dict]:
    """Steps of scaled projected gradient until expected domain totals match the targets.

    They end early when neither the scaled step, halved ``HALVINGS`` times at most, nor the plain
    gradient step brings the totals nearer by ``LEAST_GAIN``.
    """
    k = len(shares)
    n, p = F.col("n_tokens"), F.col("p")
    target = np.array(shares, float) / sum(shares) * budget
    total = float(table.agg(F.sum("n_tokens")).first()[0] or 0)
    if not total:
        return [], {"target": target.tolist(), "expected": [0.0] * k, "steps": 0, "met": False}

    def totals(steps):
        at = table.select("n_tokens", "p", fold_rate(p, steps, k, low).alias("x"))
        sums = at.agg(*[F.sum(n * F.get(p, i) * F.col("x")) for i in range(k)]).first()
        return np.array(sums, float) / total

    def gram(rows):
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        sums = rows.agg(*[F.sum(n * F.get(p, i) * F.get(p, j)) for i, j in pairs]).first()
        out = np.zeros((k, k))
        for (i, j), v in zip(pairs, sums):
            out[i, j] = out[j, i] = (v or 0.0) / total
        return out

    def moved(steps, residual):
        # documents not at their bound, or pulled away from it
        pull = sum((F.get(p, i) * F.lit(float(residual[i])) for i in range(1, k)), F.get(p, 0) * F.lit(float(residual[0])))
        return table.select("n_tokens", "p", fold_rate(p, steps, k, low).alias("x"), (pull < 0).alias("inward"),
                            (F.lit(0.0) if low is None else low).alias("low")).where("inward or x > low")

    largest = float(np.linalg.eigvalsh(gram(table))[-1])
    steps: list[list[float]] = []
    expected = totals(steps)
    while np.abs(expected - target).max() > tolerance:
        residual = expected - target
        move = np.linalg.solve(gram(moved(steps, residual)) + RIDGE * np.eye(k), residual)
        # the scaled step, ever shorter, and at last the gradient's own
        for one in [*[move / 2 ** i for i in range(HALVINGS + 1)], residual / largest]:
            longer = [*steps, one.tolist()]
            found = totals(longer)
            if np.linalg.norm(found - target) < (1 - LEAST_GAIN) * np.linalg.norm(residual):
                break
        else:
            break
        steps, expected = longer, found
    return steps, {"target": target.tolist(), "expected": expected.tolist(), "steps": len(steps),
                   "met": bool(np.abs(expected - target).max() <= tolerance)}


def rated(df: DataFrame, model: DomainModel | WordModel, shares, budget: float, key: str, text: str,
          floor) -> tuple[DataFrame, dict]:
    """Every row's own columns by position with n_tokens, p, rate and copies; and the totals reached.

    ``copies`` rounds the rate up with a probability of its fraction, by a hash of key and text.
    """
    table = stage(posteriors(df, model, text), "posteriors")
    low = None if floor is None else F.when(floor(F.col("p")), F.lit(1.0)).otherwise(F.lit(0.0))
    steps, totals = fit_rates(table, shares, budget, low=low)
    LOG.log(logging.INFO if totals["met"] else logging.WARNING, "targets %s: tokens by domain, over all tokens: "
            "target %s, expected %s after %d steps", "met" if totals["met"] else "not met",
            np.round(totals["target"], 5), np.round(totals["expected"], 5), totals["steps"])
    k, t = (F.col(f"in_{df.columns.index(c)}") for c in (key, text))
    draw = F.pmod(F.xxhash64(F.lit("copies"), k, t), F.lit(1 << 30)) / F.lit(float(1 << 30))
    table = once(table, "rate", fold_rate(F.col("p"), steps, len(shares), low))
    return table.withColumn("copies", F.floor(F.col("rate") + draw).cast("int")), totals


def rates(df: DataFrame, model: DomainModel | WordModel, shares, budget: float = 1.0, key: str = "doc_id",
          text: str = "text", floor=None) -> DataFrame:
    """(key, n_tokens, p, rate, copies, targets, reached) of every row.

    ``floor`` is a condition on the posteriors ``p`` under which a rate is 1 at least.
    ``targets`` and ``reached`` are the domains' token totals over all tokens, asked for and expected.
    """
    found, totals = rated(df.select(F.col(f"`{key}`"), F.col(f"`{text}`")), model, shares, budget, key, text, floor)
    return found.select(F.col("in_0").alias(key), "n_tokens", "p", "rate", "copies",
                        literal_doubles(totals["target"]).alias("targets"),
                        literal_doubles(totals["expected"]).alias("reached"))


def mix(df: DataFrame, model: DomainModel | WordModel, shares, budget: float = 1.0, key: str = "doc_id",
        text: str = "text", floor=None) -> DataFrame:
    """The rows, each repeated ``copies`` times, with their own columns."""
    found, _ = rated(df, model, shares, budget, key, text, floor)
    return (found.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(df.columns)]))


def domains_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, domain) from quality and toxicity labels; a row without any label has none."""
    return labels.select(F.col(f"`{key}`"), F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor")
                         .when(F.col("quality") == 1, "good").alias("domain")).where("domain is not null")


DOMAINS = ["good", "poor", "toxic"]
