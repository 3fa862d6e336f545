"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade > j) = sigmoid(x.w - theta_j): one weight vector for all thresholds, and
thresholds in rising order. A document's expected severity is the sum of these
probabilities over j. Features are the distinct words of a text and their first
4, 5 and 6 letters, present or not, so one telling word counts alike in a short
and in a very long text.

Only the fit works on a sample, of at most ``fit_rows`` labelled documents (half
from each class where there are enough). Every document is scored, on its whole
text, by one pass with the fitted weights; at most ``n_features`` of them.

Defined results
    null or empty text   no features: the grade that the thresholds alone give
    null label           the label row is ignored
    repeated labels      one of them is used in the fit
    no labels, or one class only   nothing can be learnt: severity 0, not toxic
    repeated rows        each is scored
    ties                 of features and rows in the fit are settled by name and hash
    very long texts      a set of their words and prefixes
    extra columns        kept by ``score``; its own column must be a new name
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import fresh, stage, unstage

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)


def text_features(text: str | None) -> set[str]:
    """Distinct lower-case words; prefixes are marked by a hyphen, which no word has."""
    own = set(_WORD.findall((text or "").lower()))
    return own | {f"{w[:n]}-" for n in PREFIXES for w in own if len(w) >= n}


@dataclass
class OrdinalModel:
    """Weights by feature, and rising thresholds: one fewer than there are grades."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def above(self, text: str | None) -> np.ndarray:
        """P(grade > j) for each threshold."""
        get = self.weights.get
        eta = sum(get(f, 0.0) for f in sorted(text_features(text) & self.weights.keys()))
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - eta, -40, 40)))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int, n_grades: int, ridge: float = 1.0, steps: int = 600) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that maximise the penalised likelihood, by Adam.

    ``rows`` and ``cols`` list the features present. Thresholds are a first value and the logs of the gaps, so they stay in order.
    """
    n, k = len(grades), n_grades - 1
    theta0 = np.log((np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] + 0.5) / (n - np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] + 0.5))
    params = np.concatenate([np.zeros(n_features), theta0[:1], np.log(np.maximum(np.diff(theta0), 0.05))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):
        w = params[:n_features]
        gaps = np.exp(params[n_features + 1 :])
        theta = params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])
        eta = np.bincount(rows, w[cols], minlength=n)
        cdf = 1 / (1 + np.exp(np.clip(eta[:, None] - theta, -40, 40)))  # P(grade <= j)
        edges = np.hstack([np.zeros((n, 1)), cdf, np.ones((n, 1))])
        slope = edges * (1 - edges)
        at = np.arange(n)
        p = np.maximum(edges[at, grades + 1] - edges[at, grades], 1e-9)
        up, down = slope[at, grades + 1] / p, slope[at, grades] / p
        g_eta = up - down  # of the negative log-likelihood
        g_theta = np.zeros(k)
        np.add.at(g_theta, np.minimum(grades, k - 1)[grades < k], -up[grades < k])
        np.add.at(g_theta, grades[grades > 0] - 1, down[grades > 0])
        tail = np.cumsum(g_theta[::-1])[::-1]  # a threshold moves all later ones
        grad = np.concatenate([np.bincount(cols, g_eta[rows], minlength=n_features) + ridge * w, tail[:1], tail[1:] * gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        params = params - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    gaps = np.exp(params[n_features + 1 :])
    return params[:n_features], params[n_features] + np.concatenate([[0.0], np.cumsum(gaps)])


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen, marked = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            found = text_features(text)
            seen.update(found)
            if toxic:
                marked.update(found)
    yield pd.DataFrame([(f, n, marked[f]) for f, n in seen.items() if n], columns=["feature", "n", "n_toxic"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    fit_rows: int = 8_000,
    n_features: int = 3_000,
    least_z: float = 2.5,
    cue_steps: tuple[int, ...] = (3, 6),
) -> OrdinalModel:
    """Fit on a bounded sample of labelled documents.

    Labels say toxic or not. Grade 0 is not toxic; a toxic document's grade rises from 1 by one at each of
    ``cue_steps`` distinct cue words, a cue being a word that the sample shows in toxic texts above all.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("_id IS NOT NULL AND toxic IN (0, 1)")
    half = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows // 2).collect() for c in (0, 1)]
    picked = list({r["_id"]: (r["_id"], r["toxic"]) for part in half for r in part}.values())
    if len({t for _, t in picked}) < 2:
        return OrdinalModel()
    kind = dict(docs.dtypes)[id_col]
    # At most fit_rows ids: the bound makes them fit for a broadcast.
    chosen = F.broadcast(spark.createDataFrame(picked, f"_id {kind}, toxic int"))
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(chosen, "_id").dropDuplicates(["_id"])
    sample = stage(sample.select("text", "toxic"), "toxicity-sample")
    n, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic or n_toxic == n:
        return OrdinalModel()
    counted = sample.mapInPandas(_counts, "feature string, n long, n_toxic long").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("t")).where("n >= 4")
    t, c = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    rest_t, rest_c = n_toxic - F.col("t") + 0.5, n - n_toxic - F.col("n") + F.col("t") + 0.5
    # The log odds ratio in its standard errors: what could well be chance stays out of the model.
    odds = F.log(t * rest_c / (c * rest_t))
    scored = counted.withColumn("odds", odds).withColumn("z", F.abs("odds") / F.sqrt(1 / t + 1 / c + 1 / rest_t + 1 / rest_c))
    best = scored.where(F.col("z") >= least_z).orderBy(F.desc("z"), "feature").limit(n_features).collect()
    index = {r["feature"]: i for i, r in enumerate(best)}
    cues = {r["feature"] for r in best if r["odds"] > 3}

    def design(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = text_features(text)
                own = {w for w in found if w[-1] != "-"}
                hits = sum(w in cues or any(f"{w[:k]}-" in cues for k in PREFIXES) for w in own)
                grade = int(toxic) * (1 + sum(hits >= s for s in cue_steps))
                rows.append((grade, sorted(index[f] for f in found & index.keys())))
            yield pd.DataFrame(rows, columns=["grade", "cols"])

    table = sample.mapInPandas(design, "grade int, cols array<int>").collect()
    unstage(sample)
    table.sort(key=lambda r: (r["grade"], r["cols"]))  # the fit does not depend on the order of tasks
    grades = np.array([r["grade"] for r in table])
    present, grades = np.unique(grades, return_inverse=True)  # a grade that the sample lacks gets no threshold
    rows = np.repeat(np.arange(len(table)), [len(r["cols"]) for r in table])
    cols = np.array([c for r in table for c in r["cols"]], int)
    w, theta = fit_ordinal(rows, cols, grades, len(index), len(present))
    return OrdinalModel({f: float(w[i]) for f, i in index.items()}, [float(x) for x in theta])


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text", threshold: float = 0.5, out_col: str = "_toxicity") -> DataFrame:
    """``docs`` with ``out_col``, which must be a new name: expected_severity, p_toxic, severity (the likeliest side of each threshold) and toxic."""

    if fresh(docs, out_col) != out_col:
        raise ValueError(f"there is a column {out_col} already")

    @F.pandas_udf("expected_severity double, p_toxic double, severity int, toxic boolean")
    def judge(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for t in batch:
                above = model.above(t)
                first = float(above[0]) if len(above) else 0.0
                rows.append((round(float(above.sum()), 6), round(first, 6), int((above >= 0.5).sum()), first >= threshold))
            yield pd.DataFrame(rows, columns=["expected_severity", "p_toxic", "severity", "toxic"])

    return docs.withColumn(out_col, judge(F.col(text_col)))


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not judged toxic. Columns are those of ``docs``."""
    mark = fresh(docs, "_toxicity")
    return score(docs, fit(docs, labels, **options), out_col=mark).where(~F.col(mark)["toxic"]).select(*docs.columns)
