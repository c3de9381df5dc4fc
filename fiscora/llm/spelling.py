"""Spelling variants: words one edit apart, found with a bidirectional FM-index.

Whoever differs from a word by one inserted, deleted or replaced character agrees with one of its
halves exactly. So there are two searches: match the left half up to the delimiter before it, then
extend to the right across the other half and the closing delimiter with one error; and the mirror
of it. The index holds the delimited words of a block and their reversal; a match is an interval of
suffix ranks in each, and both follow every extension, so a search can change its direction.

Words are routed by half: a word is indexed under the halves that words of its length and of one more
or less would ask for, and looked up under its own. A half that many words share is dealt
to several blocks of the index and of the lookups, and every pair of blocks is searched.

Counting words, routing, choosing forms and following them to their roots are Spark's work.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, partitions

RUN = r"[A-Za-zÀ-ÿ]+"  # what a word is made of
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_SEEN = 6, 5  # of a word
FORM_FACTOR = 5  # how much more often than a word its form occurs
LEFT, RIGHT = 0, 1  # the half that is matched exactly
BLOCK_SYMBOLS = 1 << 15  # indexed together
LOOKUPS = 1 << 12  # searched together
TASK_ROWS = 1 << 14
TABLE_ROWS = 1 << 16  # of one count table


class Ranks:
    """One direction of the index: the transform of a text read in a circle, and its counts."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        n = len(text)
        self.order = _rotations(text)
        self.transform = text[self.order - 1]
        self.step = -(-n // TABLE_ROWS)
        seen = np.zeros((n // self.step + 2, symbols + 1), dtype=np.int32)  # the last symbol stands for those that never occur
        at = np.arange(n) // self.step + 1
        np.add.at(seen, (at, self.transform), 1)
        self.seen = np.cumsum(seen, axis=0, dtype=np.int32)
        self.below = np.cumsum(self.seen, axis=1, dtype=np.int32) - self.seen
        total = np.bincount(text, minlength=symbols + 1)
        self.first = np.cumsum(total) - total

    def _rest(self, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places before ``at`` that the table has not counted yet, and for which rows they count."""
        base, rest = at // self.step * self.step, at % self.step
        return [(np.minimum(base + d, len(self.transform) - 1), rest > d) for d in range(self.step - 1)]

    def count(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often a symbol, and how often smaller ones, occur in the transform before a place."""
        same, below = self.seen[at // self.step, symbol].astype(np.int64), self.below[at // self.step, symbol].astype(np.int64)
        for place, counts in self._rest(at):
            same += counts & (self.transform[place] == symbol)
            below += counts & (self.transform[place] < symbol)
        return same, below

    def counts(self, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before a place."""
        out = self.seen[at // self.step]
        for place, counts in self._rest(at):
            out[np.flatnonzero(counts), self.transform[place[counts]]] += 1
        return out


def _rotations(text: np.ndarray) -> np.ndarray:
    """Places in the order of the text read in a circle from there, by prefix doubling."""
    n = len(text)
    padded = np.resize(text, n + 8)
    key = np.ndarray(shape=(n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    have = 8
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        if have >= n or fresh.all():
            return order
        rank = np.empty(n, dtype=np.uint64)
        rank[order] = np.cumsum(fresh)
        key = (rank << np.uint64(32)) | np.roll(rank, -have)
        have *= 2


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of words, each followed by a 0, and where each word begins."""
    chars = np.frombuffer("\0".join([*words, ""]).encode("utf-32-le"), dtype="<u4")
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    return chars, np.cumsum(sizes) - sizes


class Index:
    """Bidirectional index of distinct words."""

    def __init__(self, words: list[str]) -> None:
        chars, self.begins = _joined(words)
        self.alphabet = np.unique(chars)  # the delimiter comes first
        text = self.codes(chars).astype(np.uint8 if len(self.alphabet) < 256 else np.uint32)
        text = np.roll(text, 1)  # each word is preceded by its delimiter
        if text.dtype != np.uint8:
            raise ValueError("more than 255 different characters in a block")
        self.before, self.behind = Ranks(text, len(self.alphabet)), Ranks(text[::-1].copy(), len(self.alphabet))
        self.size = len(text)

    def codes(self, chars: np.ndarray) -> np.ndarray:
        """Symbols of characters; one more than the last for those that the index lacks."""
        found = np.minimum(np.searchsorted(self.alphabet, chars), len(self.alphabet) - 1)
        return np.where(self.alphabet[found] == chars, found, len(self.alphabet))

    @staticmethod
    def extend(side: Ranks, low: np.ndarray, other: np.ndarray, size: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, ...]:
        """Intervals on the side of an extension, on the other side, and their size."""
        same, below = side.count(low, symbol)
        same_end, below_end = side.count(low + size, symbol)
        return side.first[symbol] + same, other + below_end - below, same_end - same

    def near(self, words: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ``words`` and of indexed words that agree in that half and are one edit apart."""
        halves = [(w[: len(w) // 2][::-1], w[len(w) // 2 :]) for w in words]
        exact, exact_at = _joined([h[half] for h in halves])
        other, other_at = _joined([h[1 - half] for h in halves])
        exact, other = self.codes(exact), self.codes(other)
        sides = (self.before, self.behind) if half == LEFT else (self.behind, self.before)

        # outwards through the half, its delimiter last
        query = np.arange(len(words))
        low, across, size = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64), np.full(len(words), self.size)
        done: list[tuple[np.ndarray, ...]] = []
        step = 0
        while len(query):
            symbol = exact[exact_at[query] + step]
            low, across, size = self.extend(sides[0], low, across, size, symbol)
            end = symbol == 0
            done.append((query[end], across[end], low[end], size[end]))
            on = ~end & (size > 0)
            query, low, across, size = query[on], low[on], across[on], size[on]
            step += 1
        query, low, across, size = (np.concatenate(x) for x in zip(*done, strict=True))
        found = self._one_error(sides[1], other, other_at, query, low, across, size)
        query, low, across = found
        # both delimiters are matched: the interval is the word itself
        forward = across if half == LEFT else low
        target = np.searchsorted(self.begins, self.before.order[forward], side="left")
        pairs = np.unique(query * len(self.begins) + target)
        return pairs // len(self.begins), pairs % len(self.begins)

    def _one_error(self, side, codes, begins, query, low, across, size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Extend across the other half and its delimiter with exactly one error."""
        strayed = []  # (query, next place in the half, interval) behind the error
        step = 0
        alive = size > 0
        query, low, across, size = query[alive], low[alive], across[alive], size[alive]
        while len(query):
            at = begins[query] + step
            symbol = codes[at]
            start = side.counts(low)
            count = side.counts(low + size) - start
            row, other = np.nonzero(count[:, 1:-1])  # neither the delimiter nor what never occurs
            other = other + 1
            wrong = other != symbol[row]
            row, other = row[wrong], other[wrong]
            smaller = np.cumsum(count, axis=1) - count
            child = (side.first[other] + start[row, other], across[row] + smaller[row, other], count[row, other].astype(np.int64))
            strayed.append((query[row], np.full(len(row), step), *child))  # inserted
            inner = symbol[row] != 0
            strayed.append((query[row][inner], np.full(int(inner.sum()), step + 1), *(x[inner] for x in child)))  # replaced
            gone = symbol != 0
            gone[gone] &= codes[at[gone] + 1] != symbol[gone]  # of equal characters in a row, the last is deleted
            strayed.append((query[gone], np.full(int(gone.sum()), step + 1), low[gone], across[gone], size[gone]))
            low, across, size = self.extend(side, low, across, size, symbol)
            on = (symbol != 0) & (size > 0)
            query, low, across, size = query[on], low[on], across[on], size[on]
            step += 1
        if not strayed:
            return query, low, across
        query, place, low, across, size = (np.concatenate(x) for x in zip(*strayed, strict=True))
        found = []
        while len(query):
            symbol = codes[begins[query] + place]
            low, across, size = self.extend(side, low, across, size, symbol)
            end = (symbol == 0) & (size > 0)
            found.append((query[end], low[end], across[end]))
            on = (symbol != 0) & (size > 0)
            query, place, low, across, size = query[on], place[on] + 1, low[on], across[on], size[on]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (query, low, across)


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Near words of the lookups among the indexed words of a task."""
    out = [pd.DataFrame({"word": pd.Series(dtype=object), "near": pd.Series(dtype=object), "near_n": pd.Series(dtype="int64")})]
    for half, some in rows.groupby("half"):
        some = some.sort_values(["key", "block"], kind="stable")
        key, block, alone = some["key"].to_numpy(), some["block"].to_numpy(), some["alone"].to_numpy()
        weight = np.cumsum(np.where(some["indexed"], some["word"].str.len() + 1, 0))
        # an index for as many halves as fit; the blocks of a crowded one stand alone
        first = 0
        for i in np.flatnonzero(np.append((key[1:] != key[:-1]) | (block[1:] != block[:-1]), True)):
            full = weight[i] - (weight[first - 1] if first else 0) >= BLOCK_SYMBOLS
            if i + 1 == len(some) or full or alone[i] or alone[i + 1]:
                out += _searched(some.iloc[first : i + 1], int(half))
                first = i + 1
    return pd.concat(out)


def _searched(rows: pd.DataFrame, half: int) -> list[pd.DataFrame]:
    indexed = rows[rows["indexed"]].drop_duplicates("word")
    lookups = rows.loc[rows["lookup"], "word"].drop_duplicates().tolist()
    if indexed.empty or not lookups:
        return []
    words, seen = indexed["word"].tolist(), indexed["n"].to_numpy()
    index, out = Index(words), []
    for first in range(0, len(lookups), LOOKUPS):
        some = lookups[first : first + LOOKUPS]
        query, target = index.near(some, half)
        pairs = [(some[q], words[t], seen[t]) for q, t in zip(query.tolist(), target.tolist(), strict=True)]
        if half == RIGHT:  # who also agrees in the left half is found there
            pairs = [p for p in pairs if not p[1].startswith(p[0][: len(p[0]) // 2])]
        out.append(pd.DataFrame(pairs, columns=["word", "near", "near_n"]))
    return out


def without_character(word: Column, place: Column) -> Column:
    """A word without the character at a place, counted from 0."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def vocabulary(documents: DataFrame, noise: int | None = None, least_chars: int = LEAST_CHARS, least_seen: int = LEAST_SEEN) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough.

    With ``noise``, a run of letters loses a character in the documents where ``noise`` divides the
    hash of id and run.
    """
    rows = narrow(documents, "doc_id", "text")
    text = F.translate("text", UPPER, LOWER)
    found = rows.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    found = found.filter(F.char_length("run") >= least_chars)
    word = F.col("run")
    if noise is not None:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
        found = found.withColumn("h", h)
        place = F.pmod(F.col("h"), F.char_length("run").cast("bigint")).cast("int")
        word = F.when(F.col("h") % noise == 0, without_character(F.col("run"), place)).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.char_length("word") >= least_chars) & (F.col("n") >= least_seen))


def _routes(words: DataFrame, least_chars: int) -> DataFrame:
    """Each word under the halves it is indexed by; ``lookup`` at its own."""
    lengths = words.withColumn("l", F.char_length("word"))
    # halves of the words of one character less, as many, one more, that exist
    left = "filter(array_distinct(array((l - 1) div 2, l div 2, (l + 1) div 2)), x -> x >= {0} div 2)"
    right = "filter(array_distinct(array(l div 2, (l + 1) div 2, (l + 2) div 2)), x -> x >= ({0} + 1) div 2)"
    both = F.expr(
        f"concat(transform({left.format(least_chars)}, x -> struct({LEFT} as half, left(word, cast(x as int)) as part, x = l div 2 as lookup)), "
        f"transform({right.format(least_chars)}, x -> struct({RIGHT} as half, right(word, cast(x as int)) as part, x = (l + 1) div 2 as lookup)))"
    )
    return lengths.select("word", "n", F.explode(both).alias("r")).select(
        "word", "n", "r.half", F.xxhash64("r.half", "r.part").alias("key"), "r.lookup"
    )


def near_words(words: DataFrame, work: Workspace, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``word``, ``near``, ``near_n``: all pairs of ``words`` one edit apart, in both directions."""
    routes = work.put(_routes(words, least_chars), "routes")
    keys = routes.groupBy("key").agg(
        F.sum(F.char_length("word") + 1).alias("symbols"), F.sum(F.col("lookup").cast("int")).alias("lookups")
    )
    crowded = keys.filter((F.col("symbols") > BLOCK_SYMBOLS) | (F.col("lookups") > LOOKUPS)).select(
        "key", F.ceil(F.col("symbols") / BLOCK_SYMBOLS).alias("index_blocks"), F.ceil(F.col("lookups") / LOOKUPS).alias("lookup_blocks")
    )
    crowded = work.put(crowded, "crowded")
    dealt = routes.join(crowded, "key", "left").withColumns(
        {"index_blocks": F.coalesce("index_blocks", F.lit(1)), "lookup_blocks": F.coalesce("lookup_blocks", F.lit(1))}
    )
    # a block is a pair: one of the index, one of the lookups
    as_indexed = F.expr(
        "transform(sequence(0, lookup_blocks - 1), y -> struct(pmod(xxhash64(word), index_blocks) * lookup_blocks + y as block, "
        "true as indexed, lookup and y = pmod(xxhash64(word, 1), lookup_blocks) as lookup))"
    )
    as_lookup = F.expr(
        "transform(filter(sequence(0, index_blocks - 1), x -> lookup and x <> pmod(xxhash64(word), index_blocks)), "
        "x -> struct(x * lookup_blocks + pmod(xxhash64(word, 1), lookup_blocks) as block, false as indexed, true as lookup))"
    )
    tasks = partitions(routes.count(), TASK_ROWS)
    alone = (F.col("index_blocks") * F.col("lookup_blocks") > 1).alias("alone")
    dealt = dealt.select("word", "n", "half", "key", alone, F.explode(F.concat(as_indexed, as_lookup)).alias("b")).select(
        "word", "n", "half", "key", "alone", "b.*", F.pmod(F.xxhash64("key", "b.block"), F.lit(tasks)).alias("task")
    )
    found = dealt.groupBy("task").applyInPandas(_search, "word string, near string, near_n long")
    return work.put(found, "near")


def roots(forms: DataFrame, work: Workspace) -> DataFrame:
    """``word`` and ``root``, the last word that its forms lead to. Forms grow more frequent, so none leads back."""
    reached = work.put(forms.select("word", F.col("form").alias("root")), "roots0")
    step = 0
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(onward, "root", "left")
        step += 1
        reached = work.put(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), f"roots{step}")
        work.drop(f"roots{step - 1}")
        if reached.filter("moved").isEmpty():
            return reached.select("word", "root")
        reached = reached.select("word", "root")


def group(documents: DataFrame, noise: int | None = None, least_chars: int = LEAST_CHARS, least_seen: int = LEAST_SEEN) -> DataFrame:
    """Words with their near words, their form and the root of their group.

    Words are runs of Latin letters, A-Z lower-cased, with ``least_chars`` characters and ``least_seen``
    occurrences or more (``noise``: see ``vocabulary``). Two words are near if one inserted, deleted or replaced
    character tells them apart. Returns for every word ``form`` (its most frequent near word, ties: the
    least, if that occurs ``FORM_FACTOR`` times as often; else NULL), ``root`` (where the forms lead; the word
    itself if nowhere), ``n``, ``n_near`` and ``form_n``.

    NULL and empty texts have no words; a NULL id hashes as the empty text. Rows that repeat count each. Very
    long texts and words are taken whole. An empty table gives no rows. Other columns are ignored.
    """
    if least_chars < 2:
        raise ValueError("a word needs two halves")
    work = Workspace(documents.sparkSession, "spelling")
    words = work.put(vocabulary(documents, noise, least_chars, least_seen), "words")
    near = near_words(words, work, least_chars)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))  # text compares by code point
    chosen = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.m") >= FORM_FACTOR * F.col("n")
    told = words.join(chosen, "word", "left").select(
        "word",
        F.when(frequent, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, -F.col("best.m")).alias("form_n"),
    )
    told = work.put(told, "told")
    work.drop("routes", "near")
    led = roots(told.filter("form is not null"), work)
    return told.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
