"""Quality classifier (operator 6) by positive-unlabelled learning.

Trusted positives are documents labelled 1; unlabelled are documents whatever their label.  A linear score is
fitted by minimising the non-negative unbiased risk: prior * loss of positives as positive + max(0, loss of
unlabelled as negative - prior * loss of positives as negative).

The class prior is estimated from positives and unlabelled texts alone (``mixture_prior``): a first score is fitted
with a prior of one half to one half of the unlabelled; above the threshold where nearly only positives lie, the
share of the other half's texts over that of positives not trained on is the prior.  It can differ from the share
of 1 among the labels, as those who label choose what they label; the model keeps both.  The final score is mapped
to the probability of label 1 by a logistic curve fitted on training labels of both kinds, weighted by the prior.

Features are hashed 1- to 3-grams of bytes (log counts, length 1) and a few shape measures, so only the text is
read.  Fitting uses bounded samples of whole texts, chosen by a hash of the id: ``positives``, ``unlabelled``
and ``checked`` of each label.

Defined results: null and empty texts are scored like any other, by their (zero) features; without training
labels every score is 0.5, with labels of one kind every score is that label; of several labels for an id the
largest counts; null labels and ids are not learnt from; further columns are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.language import held_out
from rollcall.llm.tasks import as_bytes, by_arrow, lowest, sent, whole_row

GRAMS = 2048
_UPPER, _DIGIT, _SPACE, _MARK = (np.array([chr(b).isascii() and test(chr(b)) for b in range(256)]) for test in (
    str.isupper, str.isdigit, str.isspace, lambda c: c.isprintable() and not c.isalnum() and not c.isspace()))
SHAPES = 8


def features(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    out = np.zeros(GRAMS + SHAPES, np.float32)
    if not len(b):
        return out
    one = b * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (b[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (b[2:] + np.uint32(0x1656667B))) * np.uint32(0xC2B2AE35) if len(b) > 2 else two[:0]
    x = np.log1p(np.bincount(np.concatenate([one, two, three]) >> np.uint32(21), minlength=GRAMS))
    out[:GRAMS] = x / np.sqrt((x ** 2).sum())
    words, lines = text.split(), text.split(b"\n")
    n = max(1, len(words))
    raw = np.frombuffer(text, np.uint8)
    out[GRAMS:] = (_UPPER[raw].mean(), _DIGIT[raw].mean(), _SPACE[raw].mean(), _MARK[raw].mean(),
                   len(set(words)) / n, len(set(lines)) / len(lines), min(1.0, len(text) / n / 20),
                   np.log1p(n) / 12)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_linear(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, rounds: int = 40, batch: int = 256,
               rate: float = 0.02, decay: float = 1e-4, seed: int = 1) -> np.ndarray:
    """Weights (bias last) that minimise the non-negative risk with logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    p, u = (np.hstack([x, np.ones((len(x), 1), np.float32)]) for x in (positive, unlabelled))
    w, m, v, t = np.zeros(p.shape[1]), 0.0, 0.0, 0
    for _ in range(rounds):
        order = rng.permutation(len(u))
        for at in range(0, len(u), batch):
            some_u, some_p = u[order[at:at + batch]], p[rng.integers(0, len(p), batch)]
            s_u, s_p = _sigmoid(some_u @ w), _sigmoid(some_p @ w)
            as_negative = np.logaddexp(0, some_u @ w).mean() - prior * np.logaddexp(0, some_p @ w).mean()
            slope_negative = some_u.T @ s_u / len(some_u) - prior * some_p.T @ s_p / len(some_p)
            if as_negative >= 0:
                slope = -prior * some_p.T @ (1 - s_p) / len(some_p) + slope_negative
            else:  # the estimate has gone below what a risk can be: step back
                slope = -slope_negative
            slope = slope + decay * w
            t += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope ** 2
            w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def mixture_prior(positive: np.ndarray, unlabelled: np.ndarray, *, slack: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of both that no fit has seen.

    For each threshold the share of the unlabelled above it over that of the positives bounds the prior from above;
    the bound is taken where it is least after an allowance for the sizes of the samples, which holds with a
    probability of 1 - ``slack``.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    at = np.unique(p)
    above_p = 1 - np.searchsorted(p, at) / len(p)
    above_u = 1 - np.searchsorted(u, at) / len(u)
    allowance = np.sqrt(np.log(4 / slack) / 2) * (len(p) ** -0.5 + len(u) ** -0.5)
    best = ((above_u + allowance) / above_p).argmin()
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def fit_curve(z: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from a score to the probability of label 1 (Newton steps)."""
    z = z.astype(float)
    centre, spread = z.mean(), z.std() + 1e-9
    x = np.stack([(z - centre) / spread, np.ones_like(z)], axis=1)
    ab = np.zeros(2)
    for _ in range(30):
        p = _sigmoid(x @ ab)
        slope = x.T @ (weight * (p - label)) + 1e-3 * ab
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(bend, slope), -2, 2)
    return ab[0] / spread, ab[1] - ab[0] * centre / spread


class Model:
    def __init__(self, weights: np.ndarray | None, slope: float, offset: float, flat: float | None = None,
                 prior: float | None = None, labelled_share: float | None = None):
        self.weights, self.slope, self.offset, self.flat = weights, slope, offset, flat
        self.prior, self.labelled_share = prior, labelled_share

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(texts), self.flat)
        x = np.stack([features(t) for t in texts])
        return _sigmoid(self.slope * (x @ self.weights[:-1] + self.weights[-1]) + self.offset)


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        positives: int = 1500, unlabelled: int = 3000, checked: int = 800) -> Model:
    """Learn from ``labels`` (all of them; 1 is positive, any other value negative) and from ``docs`` without
    their labels."""
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), (F.col(f"`{label}`") == 1).cast("int").alias("label")).dropna()
             .groupBy("id").agg(F.max("label").alias("label")))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return Model(None, 0, 0, float(next(iter(shares))) if shares else 0.5)
    labelled_share = shares[1] / sum(shares.values())
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), as_bytes(text).alias("text")).where("id IS NOT NULL")
    marked = lowest(known, positives + checked, key="id", by="label")
    any_ids = lowest(texts.select("id"), unlabelled, key="id").select("id")
    # both lists are bounded by the parameters
    chosen = any_ids.distinct().withColumn("free", F.lit(1)).join(marked, "id", "full")

    def made(slices):
        for rows in slices:
            yield {"label": [r[0] for r in rows], "nth": [r[1] for r in rows], "free": [r[2] for r in rows],
                   "x": [features(r[3]).astype(np.float16).tobytes() for r in rows]}

    got = by_arrow(texts.join(F.broadcast(chosen), "id").select("label", "nth", "free", "text"), made,
                   "label int, nth int, free int, x binary").collect()
    got.sort(key=lambda r: r["x"])
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32) if got else np.zeros((0, 1))
    y = np.array([-1 if r["label"] is None else r["label"] for r in got])
    nth = np.array([r["nth"] or 0 for r in got])
    free = np.array([r["free"] is not None for r in got], bool)
    # where there are few labels the first half of the positives trains and the rest checks
    cut = min(positives, max(1, shares[1] // 2))
    trusted, check = (y == 1) & (nth <= cut), ((y == 1) & (nth > cut)) | (y == 0)
    if not trusted.any() or not free.any() or len(set(y[check])) < 2:
        return Model(None, 0, 0, labelled_share, labelled_share=labelled_share)
    others, unseen = x[free], check & (y == 1)
    prior = labelled_share
    if len(others) > 1:  # sorted by features, so halves are dealt in turn
        first = fit_linear(x[trusted], others[::2], 0.5)
        prior = mixture_prior(x[unseen] @ first[:-1], others[1::2] @ first[:-1])
    w = fit_linear(x[trusted], others, prior)
    z, seen = x[check] @ w[:-1] + w[-1], y[check]
    weight = np.where(seen == 1, prior / max(1, (seen == 1).sum()), (1 - prior) / max(1, (seen == 0).sum())) * len(seen)
    return Model(w, *fit_curve(z, seen, weight), prior=prior, labelled_share=labelled_share)


def scored(text: str, model: Model, spark) -> Column:
    shipped = sent(spark, model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        here = cloudpickle.loads(shipped.value)
        for texts in batches:
            out = [here.score(list(texts[at:at + 256])) for at in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(out) if out else [], dtype=float)

    return score(as_bytes(text))


def trained(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
            label: str = "quality") -> Model:
    """A model that has seen neither labels nor texts of the held-out rows (crc32 of the id modulo 4 is 2)."""
    return fit(docs.where(~held_out(doc_id, 4, 2)), labels.where(~held_out(doc_id, 4, 2)),
               doc_id=doc_id, text=text, label=label)


def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, doc_id: str = "doc_id",
             text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` without those scored below the threshold, same columns; without labels nothing is rejected."""
    model = trained(docs, labels, doc_id=doc_id, text=text, label=label)
    if model.flat is not None:
        return docs
    return docs.select(whole_row(docs), scored(text, model, docs.sparkSession).alias("score")).where(
        F.col("score") >= threshold).select("user.*")


def report(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    model = trained(docs, labels, doc_id=doc_id, text=text)
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out(doc_id, 4, 2).alias("held_out"),
                       scored(text, model, docs.sparkSession).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.7).cast("int")).withColumns({
            "class_prior": F.lit(model.prior).cast("double"),
            "labelled_share": F.lit(model.labelled_share).cast("double")})
