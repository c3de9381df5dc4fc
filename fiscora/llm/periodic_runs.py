"""Periodic runs of words, found by string synchronising sets.

A text is its sequence of words. Prefix doubling names the stretches of 1, 2, 4, ... words that
occur more than once in the text; equal names mean equal words, so how far two places agree is read
off the names, longest first.

At scale t = 2, 4, 8, ... a place is synchronising if the least hash among the stretches of t
words that begin in the t + 1 places from it is at its first or last one. Whether a place
is depends on the 2t words from it alone, and any t places of a run with a period from t on
hold one. So the next synchronising place with the same 2t words lies one period on: such pairs
propose all periods from t to 2t - 1 of runs with four periods or more.

Stretches of t words with a period up to t / 3 are highly periodic. They take no part in the least hash,
which keeps the sets small, and they are detected on their own, by the next place where their
first half recurs: these regions supply the periods below the smallest scale. Every proposal is
extended to both sides as far as the words agree.

Texts do not meet: there is no shuffle, and what a task holds is a few hundred KiB of text, or one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fiscora.llm.common import narrow
from fiscora.llm.substring_dedup import sliding_least
from fiscora.llm.words import Words, mix, steps, utf8

LEAST_WORDS, LEAST_PERIODS = 6, 4  # what makes a run
MOST = np.uint64(0xFFFFFFFFFFFFFFFF)

#: From a document's id and its number of words: the words from place ``a`` on are the first ``p`` of them over and over.
Wrap = Callable[[object, int], tuple[int, int] | None]


class Names:
    """Names of the stretches of 2^k words that recur in their text; -1 for others. ``following[k]``: where each recurs next."""

    def __init__(self, words: np.ndarray, ends: np.ndarray) -> None:
        """``words`` of some texts in a row, no two texts sharing any; ``ends``: for each word, where its text ends."""
        self.size = len(words)
        self.levels: list[np.ndarray] = []
        self.following: list[np.ndarray] = []
        places, keys, width = np.arange(self.size), words, 1
        while len(places):
            places = self._level(places, keys)
            if not len(places):
                break
            level = self.levels[-1]
            places = places[places + 2 * width <= ends[places]]
            places = places[level[places + width] >= 0]
            keys = (level[places].astype(np.int64) << 32) | level[places + width]
            width *= 2

    def _level(self, places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Name the stretches at some places by their keys; the places of those that recur."""
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        shared = np.zeros(len(order), dtype=bool)
        shared[1:] |= equal
        shared[:-1] |= equal
        if not shared.any():
            return places[:0]
        number = np.cumsum(np.concatenate(([True], ~equal))) - 1
        names = np.full(self.size + 1, -1, dtype=np.int32)
        names[places[order[shared]]] = number[shared]
        following = np.full(self.size + 1, -1, dtype=np.int32)
        following[places[order[:-1][equal]]] = places[order[1:][equal]]
        self.levels.append(names)
        self.following.append(following)
        return np.flatnonzero(names[:-1] >= 0)

    def agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words from two places on are the same; the places differ."""
        out = np.zeros(len(left), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            # the names end in a -1, which stands for all places behind the last
            a, b = (np.minimum(x + out, self.size) for x in (left, right))
            out += ((names[a] >= 0) & (names[a] == names[b])).astype(np.int64) << k
        return out

    def agree_before(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many words before two places are the same."""
        out = np.zeros(len(left), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            names = self.levels[k]
            a, b = (np.where(x - out >= 1 << k, x - out - (1 << k), self.size) for x in (left, right))
            out += ((names[a] >= 0) & (names[a] == names[b])).astype(np.int64) << k
        return out


def highly_periodic(names: Names, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where 2^k words begin that have a period up to a third of it, and the least such period (k from 2 on)."""
    following = names.following[k - 1]
    places = np.flatnonzero(following >= 0)
    period = following[places] - places
    near = 3 * period <= 1 << k
    places, period = places[near], period[near]
    whole = names.agree(places, places + period) >= (1 << k) - period
    return places[whole], period[whole]


def synchronising(names: Names, k: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising places at scale 2^k whose 2^(k+1) words recur."""
    width = 1 << k
    level = names.levels[k]
    hashes = np.where(level >= 0, mix(level.astype(np.uint64)) >> np.uint64(1), MOST)
    hashes[periodic] = MOST
    places = np.flatnonzero(names.levels[k + 1] >= 0)
    least = sliding_least(hashes, width + 1)[places]
    return places[(least != MOST) & ((hashes[places] == least) | (hashes[places + width] == least))]


def proposals(names: Names) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that may belong to a run; every run has one."""
    places, periods = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for k in range(1, len(names.levels) + 1):
        region, period = highly_periodic(names, k) if k > 1 else (places[0], periods[0])
        first = np.ones(len(region), dtype=bool)  # of a region, its first place will do
        first[1:] = (np.diff(region) != 1) | (np.diff(period) != 0)
        places.append(region[first])
        periods.append(period[first])
        if k + 1 < len(names.levels):
            chosen = synchronising(names, k, region)
            context = names.levels[k + 1][chosen]
            order = np.argsort(context, kind="stable")
            chosen, context = chosen[order], context[order]
            distance = np.diff(chosen)
            pair = (context[1:] == context[:-1]) & (distance >= 1 << k) & (distance < 2 << k)
            places.append(chosen[:-1][pair])
            periods.append(distance[pair])
    return np.concatenate(places), np.concatenate(periods)


def runs(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows ``(start, length, period)`` of the maximal runs, in order."""
    names = Names(words, ends)
    place, period = proposals(names)
    if not len(place):
        return np.zeros((0, 3), dtype=np.int64)
    start = place - names.agree_before(place, place + period)
    length = place + period + names.agree(place, place + period) - start
    enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    found = np.unique(np.column_stack([start, period, length])[enough], axis=0)
    return found[:, [0, 2, 1]]


def _sequences(counts: np.ndarray, ids: list, wrap: Wrap | None) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """For each word place, the place of the word that stands there; and the texts that are wrapped."""
    first = np.cumsum(counts) - counts
    source = np.arange(int(counts.sum()))
    wrapped: dict[int, tuple[int, int]] = {}
    if wrap is not None:
        for i, (doc_id, n) in enumerate(zip(ids, counts.tolist(), strict=True)):
            how = wrap(doc_id, n)
            if how is not None:
                begin, period = how
                at = first[i] + begin
                source[at : first[i] + n] = at + np.arange(n - begin) % period
                wrapped[i] = how
    return source, wrapped


def _text_runs(texts: list[bytes], ids: list, wrap: Wrap | None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """For each text its runs, and its words without the ones that repeat the period before them."""
    words = Words(texts)
    counts = np.diff(words.bounds)
    owners = words.owners()
    source, wrapped = _sequences(counts, ids, wrap)
    found = runs(mix(words.hashes[source] ^ mix(owners.astype(np.uint64) + np.uint64(1))), words.bounds[1:][owners])
    of = owners[found[:, 0]] if len(found) else np.zeros(0, dtype=np.int64)
    cut = np.searchsorted(of, np.arange(len(texts) + 1))
    for i, text in enumerate(texts):
        own = found[cut[i] : cut[i + 1]] - np.array([words.bounds[i], 0, 0])
        pieces = text.split()
        if i in wrapped:
            begin, period = wrapped[i]
            pieces = pieces[:begin] + [pieces[begin + j % period] for j in range(len(pieces) - begin)]
        if len(own):
            stays = np.ones(len(pieces), dtype=bool)
            for start, length, period in own.tolist():
                stays[start + period : start + length] = False
            pieces = [pieces[j] for j in np.flatnonzero(stays).tolist()]
        yield own, pieces


def find_runs(documents: DataFrame, wrap: Wrap | None = None, keep: bool = False) -> DataFrame:
    """Maximal stretches of words that repeat with a smallest period four times or more.

    A run has ``max(6, 4 * period)`` words or more, words one period apart are identical, and no
    neighbouring word continues it. Returns for every row ``doc_id``, ``n_runs``, the longest run
    (ties: least start, then period; NULL if there is none) as ``start``, ``length``, ``period``
    and ``exponent_milli`` (1000 * length / period, rounded down), ``runs_sha256`` (all runs as
    lines ``start,length,period``) and ``collapsed_sha256`` (the text's words without those that lie in a run
    after its first period, joined by spaces). With ``keep`` also ``runs`` and ``collapsed``.

    ``wrap`` may rewrite a document's words before the search, see ``Wrap``. Words are compared by 64-bit hashes
    within their text. NULL and empty texts have no words and no runs. Rows that repeat are searched each. Very
    long texts are searched whole. An empty table gives no rows. Other columns are ignored.
    """
    rows = narrow(documents, "doc_id", "text")
    number = ["n_runs", "start", "length", "period", "exponent_milli"]
    names = ["doc_id", *number, "runs_sha256", "collapsed_sha256", *(["runs", "collapsed"] if keep else [])]
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, digests, kept = batch.column("doc_id").to_pylist(), [], [], []
            for first, texts in steps(utf8(batch.column("text").to_pylist())):
                for own, pieces in _text_runs(texts, ids[first : first + len(texts)], wrap):
                    found = own.tolist()
                    longest = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                    numbers.append((len(found), *(longest or (None, None, None)), 1000 * longest[1] // longest[2] if longest else None))
                    collapsed = b" ".join(pieces)
                    listed = "".join([f"{start},{length},{period}\n" for start, length, period in found])
                    digests.append((hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()))
                    if keep:
                        kept.append(([dict(zip(("start", "length", "period"), r, strict=True)) for r in found], collapsed.decode()))
            columns = [pa.array([r[i] for r in numbers], pa.int64()) for i in range(len(number))]
            columns += [pa.array([r[i] for r in digests], pa.string()) for i in range(2)]
            if keep:
                columns += [pa.array([r[0] for r in kept], run_type), pa.array([r[1] for r in kept], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, " + ", ".join(f"{n} long" for n in number) + ", runs_sha256 string, collapsed_sha256 string"
    return rows.mapInArrow(searched, schema + (", runs array<struct<start:long,length:long,period:long>>, collapsed string" if keep else ""))
