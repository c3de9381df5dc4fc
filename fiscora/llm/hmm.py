"""Hidden Markov language model.

Symbols: the ``SYMBOLS`` most frequent words each have one, other words share one of
``CLASSES`` (by their last two bytes), and every text ends with an end symbol. ``STATES``
latent states emit symbols; within a class a word has its additively smoothed share. So

    P(text) = P(symbol sequence) * product over class words of (c + 0.1) / (class total)

which sums to one over all texts. Baum-Welch: every partition runs scaled forward and
backward recursions over its training texts and sends expected counts of starts,
transitions and emissions; Spark adds them up and the driver (a few hundred thousand
numbers, whatever the corpus) turns them into the next parameters. Scoring runs the
scaled forward recursion over whole texts.

Word counts cover all training texts and stay distributed. Only the ``KNOWN`` most
frequent words go to the tasks; the rest of the words meet their counts in a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow
from fiscora.llm.words import Words, mix, steps

STATES = 8
SYMBOLS = 4095  # words with a symbol of their own
CLASSES = 64
KNOWN = 131_072  # words whose counts go to every task
ROUNDS = 4
SEGMENT = 256  # tokens worked on in one stretch while training
SMOOTH = 0.1
FLUSH_WORDS = 4 << 20

END = SYMBOLS + CLASSES  # symbol of the end of a text
WIDTH = END + 1
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def word_classes(words: Words) -> np.ndarray:
    """Class of every word: its last two bytes, hashed."""
    last = words.buffer[words.ends - 1].astype(np.uint64)
    before = np.where(words.ends - words.starts > 1, words.buffer[np.maximum(words.ends - 2, 0)], 0).astype(np.uint64)
    return (mix((last << np.uint64(8) | before) * _GOLD) % np.uint64(CLASSES)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or b"").lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``h``, ``cls``, ``c`` for the words of a partition, added up as far as memory allows."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, cls, c = (np.concatenate(x) for x in zip(*held, strict=True))
        values, first, back = np.unique(h, return_index=True, return_inverse=True)
        return values, cls[first], np.bincount(back, weights=c).astype(np.int64)

    def sent(h: np.ndarray, cls: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(cls), pa.array(c)], names=["h", "cls", "c"])

    for batch in batches:
        for _, some in steps(_texts(batch)):
            words = Words(some)
            h, first, c = np.unique(words.hashes, return_index=True, return_counts=True)
            held.append((h, word_classes(words)[first], c))
            size += len(h)
            if size > FLUSH_WORDS:
                held = [merged()]
                size = len(held[0][0])
                if size > FLUSH_WORDS // 2:
                    yield sent(*held[0])
                    held, size = [], 0
    if held:
        yield sent(*merged())


@dataclass(frozen=True)
class Vocabulary:
    """Counts over all training texts. ``hashes`` (sorted) are the known words."""

    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    symbols: np.ndarray  # own symbol or -1
    n_tokens: int  # N, with the ends
    n_types: int  # V, with the end
    n_texts: int
    class_total: np.ndarray  # of the words without a symbol, smoothed, with room for one unseen

    @property
    def base_total(self) -> float:
        return self.n_tokens + SMOOTH * (self.n_types + 1)


def vocabulary(texts: DataFrame, n_texts: int, work: Workspace) -> tuple[DataFrame, Vocabulary]:
    """The table of all words ``(h, cls, c)``, and what every task needs of it."""
    counted = texts.select("text").mapInArrow(_count_words, "h long, cls long, c long")
    table = work.put(counted.groupBy("h").agg(F.max("cls").alias("cls"), F.sum("c").alias("c")), "vocabulary")
    # Words down to the count at which KNOWN would be exceeded; counts are told apart to a 64th of a doubling.
    rank = F.floor(F.log2("c") * 64)
    room, least = KNOWN, None
    for r in sorted(table.groupBy(rank.alias("rank")).count().collect(), key=lambda r: -r["rank"]):  # at most 64 * 64 rows
        room -= r["count"]
        if room < 0:
            break
        least = r["rank"]
    frequent = table.filter(rank >= least) if least is not None else table.limit(0)
    top = sorted(((r["h"], r["c"], r["cls"]) for r in frequent.collect()), key=lambda t: (-t[1], t[0]))
    sums = {r["cls"]: (r["c"], r["n"]) for r in table.groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()}
    own = top[:SYMBOLS]
    class_count, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    for cls, (c, n) in sums.items():
        class_count[cls], class_types[cls] = c, n
    for _, c, cls in own:
        class_count[cls] -= c
        class_types[cls] -= 1
    h = np.array([t[0] for t in top], dtype=np.int64).view(np.uint64)
    symbols = np.full(len(top), -1, dtype=np.int64)
    symbols[: len(own)] = np.arange(len(own))
    order = np.argsort(h)
    total = sum(c for c, _ in sums.values())
    return table, Vocabulary(
        hashes=h[order],
        counts=np.array([t[1] for t in top], dtype=np.int64)[order],
        classes=np.array([t[2] for t in top], dtype=np.int64)[order],
        symbols=symbols[order],
        n_tokens=total + n_texts,
        n_types=sum(n for _, n in sums.values()) + (1 if n_texts else 0),
        n_texts=n_texts,
        class_total=class_count + SMOOTH * (class_types + 1),
    )


COUNTED = "doc_id long, held_out boolean, row long, n_tokens long, n_known long, base double, within double"
ENCODED = f"{COUNTED}, symbols binary, rare array<long>, rare_class array<int>"


def _encode(vocabulary: Vocabulary):
    """Texts as symbol sequences, with what is known of their words without the join."""
    base_log = np.log10((vocabulary.counts + SMOOTH) / vocabulary.base_total)
    end_log = np.log10((vocabulary.n_texts + SMOOTH) / vocabulary.base_total) if vocabulary.base_total else 0.0
    own = vocabulary.symbols >= 0
    within_log = np.where(own, 0.0, np.log10((vocabulary.counts + SMOOTH) / vocabulary.class_total[vocabulary.classes]))
    symbol_of = np.where(own, vocabulary.symbols, SYMBOLS + vocabulary.classes).astype(np.uint16)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in steps(_texts(batch)):
                words = Words(some)
                h, cls = words.hashes, word_classes(words)
                at = np.searchsorted(vocabulary.hashes, h)
                at[at == len(vocabulary.hashes)] = 0
                known = (vocabulary.hashes[at] == h) if len(vocabulary.hashes) else np.zeros(len(h), dtype=bool)
                if not len(vocabulary.hashes):
                    symbols = (SYMBOLS + cls).astype(np.uint16)
                    base = within = np.zeros(len(h))
                else:
                    symbols = np.where(known, symbol_of[at], (SYMBOLS + cls).astype(np.uint16))
                    base, within = np.where(known, base_log[at], 0.0), np.where(known, within_log[at], 0.0)
                cuts = words.bounds

                def summed(x: np.ndarray, cuts=cuts) -> np.ndarray:
                    run = np.concatenate(([0.0], np.cumsum(x)))
                    return run[cuts[1:]] - run[cuts[:-1]]

                rare = ~known
                offsets = pa.array(np.concatenate(([0], np.cumsum(rare)))[cuts].astype(np.int32))
                part = batch.slice(first, len(some))
                texts_end = int(vocabulary.n_texts > 0)
                sequences = [np.append(symbols[a:b], np.uint16(END)).astype("<u2").tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        part.column("row"),
                        pa.array(np.diff(cuts) + 1),
                        pa.array(summed(known.astype(float)).round().astype(np.int64) + texts_end),
                        pa.array(summed(base) + end_log),
                        pa.array(summed(within)),
                        pa.array(sequences, pa.binary()),
                        pa.ListArray.from_arrays(offsets, pa.array(h[rare].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(cls[rare].astype(np.int32))),
                    ],
                    names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base", "within", "symbols", "rare", "rare_class"],
                )

    return rows


@dataclass(frozen=True)
class Parameters:
    start: np.ndarray  # [state]
    move: np.ndarray  # [from, to]
    emit: np.ndarray  # [symbol, state]


def first_guess(symbol_counts: np.ndarray) -> Parameters:
    """States that differ by a fixed random tilt of the symbol shares."""
    random = np.random.default_rng(20)
    share = (symbol_counts + SMOOTH) / (symbol_counts.sum() + SMOOTH * WIDTH)
    emit = share[:, None] * random.uniform(0.2, 1.8, size=(WIDTH, STATES))
    move = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    return Parameters(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))


def _padded(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of sequences of similar length: places, lengths, and symbols ``[time, sequence]``."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        longest = lengths[order[at]]
        some = order[at : at + max(1, min(2048, (1 << 20) // max(1, longest)))]
        some = some[lengths[some] * 2 > longest]  # little padding
        grid = np.full((longest, len(some)), END, dtype=np.int64)
        for i, k in enumerate(some):
            grid[: lengths[k], i] = sequences[k]
        yield some, lengths[some], grid
        at += len(some)


def forward_log10(sequences: list[np.ndarray], p: Parameters) -> np.ndarray:
    """log10 of the probability of every sequence, by the scaled forward recursion."""
    out, ones = np.zeros(len(sequences)), np.ones(STATES)
    for places, lengths, grid in _padded(sequences):
        alpha = np.broadcast_to(p.start, (len(places), STATES))
        total, live = np.zeros(len(places)), len(places)
        for t in range(len(grid)):
            while live and lengths[live - 1] <= t:  # lengths fall, so the living are in front
                live -= 1
            moved = alpha[:live] @ p.move if t else alpha[:live]
            alpha = moved * p.emit[grid[t, :live]]
            scale = alpha @ ones
            alpha /= scale[:, None]
            total[:live] += np.log10(scale)
        out[places] = total
    return out


def expected_counts(sequences: list[np.ndarray], p: Parameters) -> np.ndarray:
    """Expected starts, moves and emissions as one flat array.

    Long sequences are cut into stretches of ``SEGMENT``: the state distribution is carried
    forward across the cut, and the backward recursion starts anew at each.
    """
    starts, moves = np.zeros(STATES), np.zeros((STATES, STATES))
    emits, ones = np.zeros((WIDTH, STATES)), np.ones(STATES)
    for _, lengths, grid in _padded(sequences):
        alpha = np.broadcast_to(p.start, (len(lengths), STATES))
        for cut in range(0, len(grid), SEGMENT):
            piece = grid[cut : cut + SEGMENT, : int((lengths > cut).sum())]
            alive = lengths[: piece.shape[1]] - cut  # places left of every sequence
            alpha = alpha[: piece.shape[1]]
            steps_ = len(piece)
            alphas = np.empty((steps_, piece.shape[1], STATES))
            likely = p.emit[piece]
            scales = np.ones((steps_, piece.shape[1]))
            before = alpha  # distribution just before this stretch
            for t in range(steps_):
                n = int((alive > t).sum())
                moved = alpha[:n] @ p.move if t + cut else alpha[:n]
                alpha = moved * likely[t, :n]
                scales[t, :n] = alpha @ ones
                alpha = alpha / scales[t, :n, None]
                alphas[t, :n], alphas[t, n:] = alpha, 0.0
            beta = np.ones((piece.shape[1], STATES))
            for t in range(steps_ - 1, -1, -1):
                n = int((alive > t).sum())
                ends = alive == t + 1
                beta[ends] = 1.0
                gamma = alphas[t, :n] * beta[:n]
                gamma /= gamma.sum(axis=1, keepdims=True)
                weighted = likely[t, :n] * beta[:n] / scales[t, :n, None]
                if t:
                    prior = alphas[t - 1, :n]
                elif cut:
                    prior = before[:n]
                else:
                    prior = None
                    starts += gamma.sum(axis=0)
                if prior is not None:
                    moves += p.move * (prior.T @ weighted)
                alphas[t, :n] = gamma  # its own value is not needed any more
                beta[:n] = weighted @ p.move.T
            for k in range(STATES):
                emits[:, k] += np.bincount(piece.ravel(), weights=alphas[:, :, k].ravel(), minlength=WIDTH)
    return np.concatenate([starts, moves.ravel(), emits.ravel()])


def reestimated(counts: np.ndarray, symbol_counts: np.ndarray) -> Parameters:
    """Parameters from expected counts, smoothed; emissions lean a little on the symbol shares."""
    start, move = counts[:STATES], counts[STATES : STATES + STATES * STATES].reshape(STATES, STATES)
    emit = counts[STATES + STATES * STATES :].reshape(WIDTH, STATES)
    share = (symbol_counts + SMOOTH) / (symbol_counts.sum() + SMOOTH * WIDTH)
    emit = emit + 10.0 * share[:, None]
    move, start = move + SMOOTH, start + SMOOTH
    return Parameters(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _sequences(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(s, dtype="<u2").astype(np.int64) for s in batch.column("symbols").to_pylist()]


def _sums(work_on):
    """Add up what ``work_on`` makes of each batch, and send one row per number of a partition."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            found = work_on(_sequences(batch))
            total = found if total is None else total + found
        if total is not None:
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["i", "x"])

    return rows


def _gathered(frame: DataFrame, work_on, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in frame.select("symbols").mapInArrow(_sums(work_on), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r["i"]] = r["x"]
    return out


def train(encoded: DataFrame, rounds: int = ROUNDS) -> Parameters:
    """Baum-Welch over every encoded text."""

    def count(sequences: list[np.ndarray]) -> np.ndarray:
        return sum((np.bincount(s, minlength=WIDTH) for s in sequences), np.zeros(WIDTH)).astype(float)

    symbol_counts = _gathered(encoded, count, WIDTH)
    parameters = first_guess(symbol_counts)
    for _ in range(rounds):
        now = parameters
        counts = _gathered(encoded, lambda s, now=now: expected_counts(s, now), STATES + STATES * STATES + WIDTH * STATES)
        parameters = reestimated(counts, symbol_counts)
    return parameters


def score(documents: DataFrame, held_out: Column, rounds: int = ROUNDS) -> DataFrame:
    """Likelihood of every text under a model learnt from the rows where ``held_out`` is false.

    Returns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens seen in
    training), ``train_tokens``, ``base_score`` (additive unigram, log10) and ``score`` (hidden
    Markov model, log10).

    NULL and empty texts are the end token alone. ``held_out`` is a condition on ``doc_id``; where
    it is NULL (no id) the row is learnt from. Repeated rows count each time. With no
    training rows every word is unseen. An empty table gives no rows. Other columns are ignored.
    """
    work = Workspace(documents.sparkSession, "hmm")
    rows = narrow(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    training = rows.filter(~F.col("held_out"))
    table, known = vocabulary(training, training.count(), work)
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # written with the row, so it lasts
    encoded = work.put(numbered.mapInArrow(_encode(known), ENCODED), "encoded")
    parameters = train(encoded.filter(~F.col("held_out")), rounds)

    words = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_class")).alias("w"))
    words = words.select("row", F.col("w.rare").alias("h"), F.col("w.rare_class").alias("cls"))
    totals = [float(x) for x in known.class_total]
    counted = words.join(table.select("h", "c"), "h", "left")
    count = F.coalesce("c", F.lit(0)) + SMOOTH
    per_text = counted.groupBy("row").agg(
        F.count("c").alias("rare_known"),
        F.sum(F.log10(count / known.base_total)).alias("rare_base"),
        F.sum(F.log10(count / F.get(F.array(*[F.lit(x) for x in totals]), F.col("cls")))).alias("rare_within"),
    )

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = forward_log10(_sequences(batch), parameters)
            names = [c.split()[0] for c in COUNTED.split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found)], names=[*names, "chain"])

    scored = encoded.drop("rare", "rare_class").mapInArrow(forward, f"{COUNTED}, chain double")
    return scored.join(per_text, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("chain") + F.col("within") + F.coalesce("rare_within", F.lit(0.0))).alias("score"),
    )
