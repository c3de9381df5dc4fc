"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause: insult, threat, target, negation and
reported speech. They are composed into one automaton whose end state says what the clause
is: an insult or threat, plain or negated, aimed at somebody, reported or said outright.
Only matched clauses score. The terms of the insult transducer are learnt from labels (words
and word stems that occur far more often in toxic documents) next to the fixed seed
words; the weights of the clause kinds are learnt too, around fixed expectations.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import by_place, narrow
from fiscora.llm.labels import SAMPLE_ROWS, training_texts

MAX_TERMS = 10_000  # terms kept, those with the strongest evidence
STEMS = (4, 5, 6)  # letters of a stem
PURITY = 20.0  # a learnt term is so many times likelier in toxic documents

# Seed words of the transducers (lower case, whole words).
INSULTS = "idiot moron scum loser imbecile dumbass bastard arschloch trottel vollidiot connard abruti salaud imbécil estúpido gilipollas".split()
THREATS = "kill murder strangle stab shoot maim töten umbringen tuer assassiner matar asesinar".split()
TARGETS = "you your yourself u ya du dich dir ihr euch tu te toi vous tú usted vosotros".split()
NEGATIONS = "not never neither nor isn aren wasn don doesn didn nicht kein keine niemals pas jamais nunca jamás".split()
REPORTS = "said says wrote claimed called quoted reported alleged sagte schrieb behauptete dit écrit déclaré dijo escribió".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
NEGATION_REACH = 3  # words after a negation that it covers

TOKEN = re.compile(r"[^\W\d_]+|[.,;:!?\n]")
CLAUSE_END = frozenset(".,;:!?\n")

# Clause kinds become these sums; the second number is the weight expected before learning.
FEATURES = (
    ("matched", 1.5),
    ("insult", 1.0),
    ("insult_negated", -1.0),
    ("threat", 1.0),
    ("threat_negated", -1.0),
    ("targeted", 0.5),
    ("reported", -1.0),
)


def _negation(state: int, symbol: int) -> int:
    return NEGATION_REACH if symbol == NEGATION else max(0, state - 1)


def _offence(kind: int):
    """0 none, 1 negated, 2 plain. A plain match outweighs a negated one."""

    def step(state: int, symbol: int, negated: bool) -> int:
        return max(state, 1 if negated else 2) if symbol == kind else state

    return step


_insult, _threat = _offence(INSULT), _offence(THREAT)


def compose() -> tuple[np.ndarray, list[tuple[int, int, int, int, int]]]:
    """Transition table ``[state, symbol]`` and the component states behind each state.

    A state is (negation, insult, threat, target, report); state 0 is the start.
    """
    states = list(product(range(NEGATION_REACH + 1), range(3), range(3), range(2), range(2)))
    number = {s: i for i, s in enumerate(states)}
    table = np.zeros((len(states), 6), dtype=np.int32)
    for (neg, ins, thr, tar, rep), symbol in product(states, range(6)):
        after = (
            _negation(neg, symbol),
            _insult(ins, symbol, neg > 0),
            _threat(thr, symbol, neg > 0),
            max(tar, int(symbol == TARGET)),
            max(rep, int(symbol == REPORT)),
        )
        table[number[neg, ins, thr, tar, rep], symbol] = number[after]
    return table, states


@dataclass(frozen=True)
class Grammar:
    """Learnt terms with their weights, and the composed automaton."""

    words: dict[str, float]
    stems: dict[str, float]

    def __post_init__(self) -> None:
        table, states = compose()
        symbols = {w: s for s, some in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in some}
        object.__setattr__(self, "_table", table.tolist())
        object.__setattr__(self, "_states", states)
        object.__setattr__(self, "_symbols", symbols)

    def term(self, word: str) -> float:
        """Weight of a word as an insult, 0 for none."""
        found = self.words.get(word, 0.0)
        if not found:
            for n in STEMS:
                if len(word) > n:
                    found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def features(self, text: str | None) -> list[float]:
        """Sums over the clauses of a text, in the order of ``FEATURES``."""
        tokens = TOKEN.findall(text.lower()) if text else []
        terms = {w: s for w in set(tokens) if (s := self.term(w)) or self._symbols.get(w) == THREAT}
        sums = dict.fromkeys((name for name, _ in FEATURES), 0.0)
        if terms:
            state, weight = 0, 0.0
            for token in [*tokens, "."]:
                if token in CLAUSE_END:
                    if weight:
                        self._add(sums, self._states[state], weight)
                    state, weight = 0, 0.0
                    continue
                symbol = self._symbols.get(token, OTHER)
                if token in terms:
                    symbol = THREAT if symbol == THREAT else INSULT
                    weight += terms[token] or 1.0
                state = self._table[state][symbol]
        return [math.log1p(sums[name]) for name, _ in FEATURES]

    @staticmethod
    def _add(sums: dict[str, float], state: tuple[int, int, int, int, int], weight: float) -> None:
        _, insult, threat, target, report = state
        sums["matched"] += weight
        for name, value in (("insult", insult), ("threat", threat)):
            if value:
                sums[name if value == 2 else f"{name}_negated"] += weight
        if target:
            sums["targeted"] += weight
        if report:
            sums["reported"] += weight


def learn_terms(texts: DataFrame, max_terms: int = MAX_TERMS) -> Grammar:
    """Insult terms from ``(text, y)`` rows.

    A term is kept if its likelihood ratio beats what the best of so many candidates reaches
    by chance, and if it is ``PURITY`` times likelier in toxic rows. A stem counts as often as
    the words that begin with it, all but one.
    """
    totals = texts.groupBy("y").count().collect()
    rows = {0: 0, 1: 0} | {r["y"]: r["count"] for r in totals}
    weight = dict.fromkeys(INSULTS, 1.0)
    if not rows[0] or not rows[1]:
        return Grammar(weight, {})
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), F.lit(1))))
    words = texts.select("y", word.alias("word")).groupBy("word").agg(F.sum("y").alias("toxic"), F.count("*").alias("all"))
    stems = (
        words.withColumn("n", F.explode(F.array(*[F.lit(n) for n in STEMS])))
        .filter(F.length("word") > F.col("n"))
        .groupBy(F.expr("left(word, n)").alias("word"))
        # without its most toxic word, which stands for itself
        .agg(
            (F.sum("toxic") - F.max("toxic")).alias("toxic"),
            (F.sum("all") - F.max_by("all", F.struct("toxic", "word"))).alias("all"),
        )
    )
    both = words.withColumn("stem", F.lit(False)).unionByName(stems.withColumn("stem", F.lit(True))).cache()
    share = rows[1] / (rows[0] + rows[1])

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    clean = F.col("all") - F.col("toxic")
    evidence = 2 * (part(F.col("toxic"), F.col("all") * share) + part(clean, F.col("all") * (1 - share)))
    ratio = ((F.col("toxic") + 0.5) / (rows[1] + 1)) / ((clean + 0.5) / (rows[0] + 1))
    bar = 2 * math.log(max(2, both.count())) + 4
    found = (
        both.withColumn("evidence", evidence)
        .withColumn("ratio", ratio)
        .filter((F.col("evidence") > bar) & (F.col("ratio") > PURITY))
        .orderBy(F.desc("evidence"), "word", "stem")
        .limit(max_terms)
        .collect()
    )
    both.unpersist()
    stem_weight: dict[str, float] = {}
    for r in found:
        kept = stem_weight if r["stem"] else weight
        kept[r["word"]] = max(kept.get(r["word"], 0.0), math.log(r["ratio"]))
    return Grammar(weight, stem_weight)


@dataclass(frozen=True)
class Model:
    grammar: Grammar
    weights: np.ndarray  # bias first

    def scores(self, texts) -> np.ndarray:
        x = np.array([self.grammar.features(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + x @ self.weights[1:], -500, 500)))


def fit_weights(x: np.ndarray, y: np.ndarray, pull: float = 0.05) -> np.ndarray:
    """Logistic weights, bias first, pulled towards the expected ones of ``FEATURES``."""
    expected = np.array([-3.0, *[w for _, w in FEATURES]])
    design, weights = np.column_stack([np.ones(len(x)), x]), expected.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -50, 50)))
        v = np.maximum(p * (1 - p), 1e-9)
        gradient = design.T @ (p - y) + pull * (weights - expected)
        step = np.linalg.solve((design * v[:, None]).T @ design + pull * np.eye(len(weights)), gradient)
        weights = weights - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def one_of_each(texts: DataFrame) -> DataFrame:
    """Training rows without copies: of texts that share their least three-word shingle hash, one.

    The words of a text that was copied a hundred times would else look like toxic terms.
    """
    words = F.split(F.lower("text"), r"[^\p{L}]+")
    least = F.expr("array_min(transform(sequence(0, greatest(size(w) - 3, 0)), i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))")
    keyed = texts.filter(F.col("text").isNotNull()).withColumn("w", words).withColumn("key", least)
    return keyed.groupBy("key").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.max("y").alias("y")).select("text", "y")


def learn(documents: DataFrame, labels: DataFrame, learn_from: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Terms and weights from at most ``sample_rows`` labelled rows whose ``doc_id`` meets ``learn_from``."""
    texts = one_of_each(training_texts(documents, labels, "toxic", learn_from, sample_rows)).cache()
    grammar = learn_terms(texts)

    def clauses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"x": [grammar.features(t) for t in batch["text"]], "y": batch["y"].to_numpy()})

    counted = texts.mapInPandas(clauses, "x array<double>, y int").groupBy("x", "y").count().collect()  # most rows match nothing
    texts.unpersist()
    counted.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([r["x"] for r in counted for _ in range(r["count"])], dtype=float).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in counted for _ in range(r["count"])], dtype=float)
    return Model(grammar, fit_weights(x, y))


def score_column(model: Model):
    """A column function from texts to toxicity scores."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(t if isinstance(t, str) else None for t in batch), dtype="float64")

    return scores


def score(
    documents: DataFrame, labels: DataFrame, learn_from: Column, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``doc_id``, ``score`` (likelihood of label 1) and ``predicted`` of every document row.

    NULL and empty texts match nothing and get the score of a document without a
    matched clause. Labels with a NULL id or value are ignored; without labels of both
    classes the seed words and expected weights stand alone. Other columns are ignored.
    """
    scores = score_column(learn(documents, labels, learn_from, sample_rows))
    return narrow(documents, "doc_id", "text").select("doc_id", scores("text").alias("score")).select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def acceptable(documents: DataFrame, labels: DataFrame, learn_from: Column, threshold: float = 0.7) -> DataFrame:
    """The documents, all columns, without those that score ``threshold`` or more."""
    scores = score_column(learn(documents, labels, learn_from))
    plain, names, at = by_place(documents)
    return plain.filter(scores(at["text"]) < threshold).toDF(*names)
