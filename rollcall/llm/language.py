"""Language identification (operator 5): sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the 1- to 3-grams of a text's lower-case characters, hashed to ``FEATURES`` numbers, with
1 + log(count) times inverse document frequency, scaled to length 1.  Document frequencies are counted over
all training documents.  Weights are fitted by follow-the-regularised-leader with elastic-net penalties on a
bounded sample (``sample`` documents in all, shared evenly by the languages, whole texts, chosen by a hash of
the id) and calibrated by a temperature on a part of it.  Predictions read the text alone.

Defined results: ``und`` with score 0 when a text is null, empty or has no letter, or when there is nothing
to learn from; a null language or id is not learnt from; repeated rows are learnt as often as they occur;
texts are read whole, however long; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm import ftrl
from rollcall.llm.tasks import by_arrow, lowest, sent

FEATURES = 1 << 14


def grams(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    one = c * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (c[2:] + np.uint32(0x1656667B))) * np.uint32(0xC2B2AE35) if len(c) > 2 else two[:0]
    return np.bincount(np.concatenate([one, two, three]) >> np.uint32(18), minlength=FEATURES)


def row(text: str, idf: np.ndarray) -> ftrl.Row:
    counts = grams(text)
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((values ** 2).sum())
    return at, values / norm if norm else values


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    key = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % folds
    return F.coalesce(key == fold, F.lit(False))


class Model:
    def __init__(self, names: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.names, self.idf, self.weights, self.temperature = names, idf, weights, temperature

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or not text or not any(map(str.isalpha, text)):
            return "und", 0.0
        at, values = row(text, self.idf)
        p = ftrl.softmax(values @ self.weights[at] / self.temperature)
        best = int(p.argmax())
        return self.names[best], float(p[best])


def fit(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        sample: int = 2400) -> Model:
    """Learn from all rows of ``docs`` that have an id, a text and a language: frequencies from all, weights from
    ``sample`` rows at most, of rows that share an id one."""
    known = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"),
                        F.col(f"`{text}`").cast("string").alias("text")).dropna()

    def frequencies(slices):
        seen, n = np.zeros(FEATURES, np.int64), 0
        for rows in slices:
            for (x,) in rows:
                seen += grams(x) > 0
            n += len(rows)
        yield {"feature": np.arange(-1, FEATURES), "n": np.concatenate([[n], seen])}

    counted = by_arrow(known.select("text"), frequencies, "feature int, n bigint").groupBy("feature").agg(
        F.sum("n").alias("n")).collect()  # FEATURES + 1 rows
    seen = np.zeros(FEATURES + 1, np.int64)
    for r in counted:
        seen[r["feature"]] = r["n"]  # -1 is the last place: the number of documents
    idf = np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1
    n_langs = known.select("lang").distinct().count()
    if not n_langs:
        return Model([], idf, np.zeros((FEATURES, 0)), 1.0)
    ids = known.select("id", "lang")
    # as many of each language; with more languages than the sample has rows, rows of any
    chosen = lowest(ids, sample // n_langs, key="id", by="lang") if n_langs <= sample else lowest(ids, sample, key="id")
    chosen = chosen.select("id").distinct()

    def features(slices):
        for rows in slices:
            made = [row(x, idf) for _, x in rows]
            yield {"lang": [r[0] for r in rows], "at": [a.astype(np.uint16).tobytes() for a, _ in made],
                   "value": [v.astype(np.float32).tobytes() for _, v in made]}

    # a bounded sample
    picked = known.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min(F.struct("lang", "text")).alias("row"))
    got = by_arrow(picked.select("row.lang", "row.text"), features,
                   "lang string, at binary, value binary").collect()
    got.sort(key=lambda r: (r["lang"], r["at"], r["value"]))
    names = sorted({r["lang"] for r in got})
    rows = [(np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["value"], np.float32).astype(float))
            for r in got]
    return Model(names, idf, *ftrl.fit(rows, [names.index(r["lang"]) for r in got], FEATURES, len(names),
                                       alpha=2.0, l1=1e-3, l2=1e-3))


def predicted(text: Column, model: Model, spark) -> Column:
    """Struct of lang_pred and score."""
    shipped = sent(spark, model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        here = cloudpickle.loads(shipped.value)
        for texts in batches:
            yield pd.DataFrame([here.predict(x) for x in texts], columns=["lang_pred", "score"])

    return predict(text)


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    out = held_out(doc_id, 5, 0)
    model = fit(docs.where(~out), doc_id=doc_id, text=text, lang=lang)
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), out.alias("held_out"),
                       predicted(F.col(f"`{text}`"), model, docs.sparkSession).alias("p")).select(
        "doc_id", "held_out", "p.lang_pred", "p.score")
