"""Quality classifier: support vectors on n-gram indicators scaled by class log-count ratios.

The n-grams are words, and runs of one to three word shapes (letters folded to ``a`` and
``A``, digits to ``0``, other signs kept), with a mark where a word repeats the one before.
Indicators go into ``2 ** BITS`` hashed columns, are multiplied by

    log((1 + rows of class 1 with it) / |class 1|) - log((1 + rows of class 0 with it) / |class 0|)

and scaled to length 1; a linear hinge-loss model is fitted on them by dual coordinate
descent. A sigmoid fitted on margins of rows left out turns margins into scores.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import narrow
from fiscora.llm.labels import SAMPLE_ROWS, training_texts
from fiscora.llm.words import Words, mix, steps, utf8

BITS = 18
COST = 1.0
PASSES = 12

_SHAPE = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"a+|A+|0+")


def indicators(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(columns, bounds)`` for runs of texts: the distinct hashed n-grams of each."""
    for _, some in steps(texts):
        plain = Words([t.lower() for t in some])
        shape = Words([_RUN.sub(lambda m: m[0][:1], t.translate(_SHAPE)) for t in some])
        owner = plain.owners()
        again = np.concatenate(([False], (plain.hashes[1:] == plain.hashes[:-1]) & (owner[1:] == owner[:-1]))) if len(owner) else owner > 0
        one = mix(shape.hashes ^ again.astype(np.uint64))
        grams = [(plain.hashes, owner), (one, owner)]
        chain = one
        for j in (1, 2):
            chain = mix(chain[:-1] * np.uint64(31) + one[j:]) if len(chain) > 1 else chain[:0]
            inside = owner[: len(chain)] == owner[j:] if len(chain) else owner[:0]
            grams.append((chain[inside], owner[: len(chain)][inside]))
        columns = [mix(h + np.uint64(i)) >> np.uint64(64 - BITS) for i, (h, _) in enumerate(grams)]
        keys = [(o.astype(np.uint64) << np.uint64(BITS)) | c for (_, o), c in zip(grams, columns, strict=True)]
        keys = np.unique(np.concatenate(keys))
        bounds = np.searchsorted(keys, np.arange(len(some) + 1, dtype=np.uint64) << np.uint64(BITS))
        yield (keys & np.uint64((1 << BITS) - 1)).astype(np.int32), bounds


@dataclass(frozen=True)
class Model:
    """Weights per column (ratio and fitted weight multiplied), squared ratios, bias, sigmoid."""

    weight: np.ndarray
    ratio2: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, texts: list[bytes]) -> np.ndarray:
        out = []
        for columns, bounds in indicators(texts):
            dots = np.concatenate(([0.0], np.cumsum(self.weight[columns])))
            norms = np.concatenate(([0.0], np.cumsum(self.ratio2[columns])))
            length = np.sqrt(np.maximum(norms[bounds[1:]] - norms[bounds[:-1]], 1e-12))
            out.append((dots[bounds[1:]] - dots[bounds[:-1]]) / length + self.bias)
        return np.concatenate(out) if out else np.zeros(0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    counts = np.ones((2, 1 << BITS))
    for columns, label in zip(rows, y, strict=True):
        counts[label, columns] += 1
    return np.log(counts[1] / (2 + (y == 1).sum())) - np.log(counts[0] / (2 + (y == 0).sum()))


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + COST * sum of weighted hinge losses."""
    sign = np.where(y == 1, 1.0, -1.0)
    # both classes weigh the same in total
    upper = np.where(y == 1, COST * len(y) / max(1, 2 * (y == 1).sum()), COST * len(y) / max(1, 2 * (y == 0).sum()))
    values = []
    for columns in rows:
        x = ratio[columns]
        values.append(x / max(np.sqrt((x * x).sum()), 1e-6))
    weight, bias, alpha = np.zeros(1 << BITS), 0.0, np.zeros(len(rows))
    square = np.array([(x * x).sum() + 1.0 for x in values])  # 1: the bias column
    random = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in random.permutation(len(rows)):
            columns, x = rows[i], values[i]
            gradient = sign[i] * (weight[columns] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weight[columns] += step * x
                bias += step
                alpha[i] = new
    return weight, bias


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest sigmoid, with targets drawn in a little from 0 and 1."""
    target = np.where(y == 1, ((y == 1).sum() + 1) / ((y == 1).sum() + 2), 1 / ((y == 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        v = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-9]])
        da, db = np.linalg.solve(h, g)
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
        if abs(da) + abs(db) < 1e-9:
            break
    return float(a), float(b)


def fit(rows: list[np.ndarray], y: np.ndarray) -> Model:
    """A model from indicator rows. With one class only, or none, every score is that share of 1 (none: 0.5)."""
    zero = np.zeros(1 << BITS)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(zero, zero + 1, 0.0, 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))

    def trained(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        some = [rows[i] for i in chosen]
        ratio = log_count_ratios(some, y[chosen])
        weight, bias = dual_coordinate_descent(some, y[chosen], ratio)
        return weight * ratio, ratio * ratio, bias

    def margin(columns: np.ndarray, weight: np.ndarray, ratio2: np.ndarray, bias: float) -> float:
        return weight[columns].sum() / np.sqrt(max(ratio2[columns].sum(), 1e-12)) + bias

    left_out = np.zeros(len(y))
    for part in (0, 1):
        held = np.arange(len(y)) % 2 == part
        if len(set(y[~held].tolist())) == 2:
            model = trained(np.flatnonzero(~held))
            left_out[held] = [margin(rows[i], *model) for i in np.flatnonzero(held)]
    weight, ratio2, bias = trained(np.arange(len(y)))
    return Model(weight, ratio2, bias, *_sigmoid(left_out, y))


def learn(texts: DataFrame) -> Model:
    """Fit on ``(text, y)`` rows; their indicators, a bounded sample's, come to the driver."""

    def columns(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[bytes] = []
            for found, bounds in indicators(utf8(batch["text"])):
                out.extend(found[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True))
            yield pd.DataFrame({"x": out, "y": batch["y"].to_numpy()})

    # in an order of its own, so that the fit does not depend on how rows arrive
    data = sorted((bytes(r["x"]), r["y"]) for r in texts.mapInPandas(columns, "x binary, y int").toLocalIterator())
    order = np.random.default_rng(11).permutation(len(data))
    return fit([np.frombuffer(data[i][0], dtype=np.int32) for i in order], np.array([data[i][1] for i in order], dtype=int))


def score_column(model: Model):
    """A column function from texts to quality scores."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(utf8(batch)), dtype="float64")

    return scores


def score(
    documents: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    threshold: float = 0.3,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id``, ``score`` (likelihood of label 1) and ``predicted`` of every document row.

    ``learn_from`` is a condition on ``doc_id``; at most ``sample_rows`` labelled rows are used
    for the fit. NULL and empty texts get the score of a text without n-grams. Labels with
    a NULL id or value are ignored; without labels of both classes all scores are equal.
    Other columns are ignored.
    """
    model = learn(training_texts(documents, labels, "quality", learn_from, sample_rows))
    scores = score_column(model)
    return narrow(documents, "doc_id", "text").select("doc_id", scores("text").alias("score")).select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )

