"""Exact substring deduplication: bytes covered by a long string that occurs elsewhere.

Blocks. Every window of ``length`` bytes belongs to the place of its least hashed
``GRAM``-gram; consecutive windows with the same place form a block. Equal windows pick the
same gram at the same offset, so they lie in blocks with the same key, and each window lies
in one block only. A key that occurs once holds nothing repeated, and copies of a block are
counted before anything is indexed.

Index. The distinct blocks of some keys form the text of one task. Its suffix array gives the
Burrows-Wheeler transform, and breadth-first backward extension of intervals fills in
longest common prefixes in increasing order: extending the interval of a string w by c
ends at a boundary whose common prefix is |w| unless a shorter string found it before. The
search starts with the strings of ``SEED`` bytes and stops at ``length``: boundaries still
open then have common prefixes of at least ``length``, and the suffixes beside them begin
with a repeated string. Intervals never extend over the end of a block.

Hot keys. A key with more than ``HOT_BLOCKS`` distinct blocks (a short passage in countless
surroundings) is not indexed in one task. Its blocks are cut again with a longer gram, halfway to
``length``, and then with one of ``length`` bytes, where a block is one window and a key has one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, partitions
from fiscora.llm.words import mix

LENGTH = 200
GRAM = 32
SEED = 8
HOT_BLOCKS = 2048
TASK_BYTES = 2 << 20  # of blocks indexed together
INDEX_BYTES = 256 << 10  # of blocks in one suffix array; more leaves the caches
STEP_BYTES = 256 << 10  # of text cut into blocks together, for the same reason
PIECE_BYTES = 16 << 20  # of one text
PLACE_BITS = 25
SEPARATOR = 0xFF  # never a byte of UTF-8 text

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << PLACE_BITS) - 1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Mixed polynomial hash of the ``size`` bytes from every place (shorter at the end)."""
    out, width = None, 0
    power, power_width = data.astype(np.uint64) + np.uint64(1), 1

    def joined(left: np.ndarray, right: np.ndarray, left_width: int, right_width: int) -> np.ndarray:
        factor = np.uint64(pow(int(_BASE), right_width, 1 << 64))
        result = left * factor
        if left_width < len(result):
            result[: len(result) - left_width] += right[left_width:]
        return result

    while True:
        if size & power_width:
            out, width = (power, power_width) if out is None else (joined(out, power, width, power_width), width + power_width)
        if power_width * 2 > size:
            return mix(out)
        power, power_width = joined(power, power, power_width, power_width), power_width * 2


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` values from every place; the last ``width - 1`` places are cut off."""
    least, have = x, 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def cut_blocks(data: bytes, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of joined texts: text number, first byte in ``data``, bytes, key."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64)
    hashes = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)
    packed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_least(packed[: len(packed) - gram + 1], length - gram + 1)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + length <= bounds[1:][owner])
    if not len(starts):
        return none, none, none, none.view(np.uint64)
    place = least[starts] & _PLACE
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(starts) != 1))))
    windows = np.diff(np.append(first, len(starts)))
    return owner[starts[first]], starts[first], windows + length - 1, hashes[place[first].astype(np.int64)]


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, list[int], list[int]]]:
    """Joined texts with bounds, their numbers and offsets. A long text comes in overlapping pieces."""
    held: list[bytes] = []
    numbers: list[int] = []
    offsets: list[int] = []
    size = 0

    def joined() -> tuple[bytes, np.ndarray, list[int], list[int]]:
        return b"".join(held), np.cumsum([0] + [len(t) for t in held]), numbers, offsets

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
            held.append(text[at : at + PIECE_BYTES + length - 1])
            numbers.append(i)
            offsets.append(at)
            size += len(held[-1])
            if size >= STEP_BYTES:
                yield joined()
                held, numbers, offsets, size = [], [], [], 0
    if held:
        yield joined()


def _digests(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    found = (xxhash.xxh3_64_intdigest(data[a : a + n]) for a, n in zip(start.tolist(), size.tolist(), strict=True))
    return np.fromiter(found, dtype=np.uint64, count=len(start))


def _block_rows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for data, bounds, numbers, offsets in _pieces(texts, length):
                owner, start, size, key = cut_blocks(data, bounds, length, min(GRAM, length))
                content = _digests(data, start, size)
                row = np.array(numbers)[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        batch.column("t").take(pa.array(row)),
                        pa.array(np.array([len(t) for t in texts], dtype=np.int32)[row]),
                        pa.array((start - bounds[owner] + np.array(offsets)[owner]).astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    names=["key", "content", "t", "size", "start", "n"],
                )

    return rows


BLOCK = "key long, content long, t long, size int, start int, n int"


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of the ``depth`` bytes that follow them, and the groups equal in ``SEED`` bytes.

    Prefix doubling. The second array marks, in that order, where a new group begins.
    """
    n = len(text)
    padded = np.concatenate([text, np.full(SEED, SEPARATOR, dtype=np.uint8)])
    key = np.ndarray(shape=(n,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key)
    sorted_key = key[order]
    fresh = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    seeds = fresh
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    have = SEED
    while have < depth:
        # only places whose group has others can still move
        group = rank[order]
        alone = fresh & np.append(fresh[1:], True)
        open_at = np.flatnonzero(~alone)
        if not len(open_at):
            break
        places = order[open_at]
        nxt = np.minimum(places + have, n)
        second = np.where(places + have < n, np.append(rank, 0)[nxt], -1)
        pair = (group[open_at].astype(np.uint64) << np.uint64(32)) | (second + 1).astype(np.uint64)
        inner = np.argsort(pair)
        order[open_at] = places[inner]
        pair = pair[inner]
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        fresh = fresh.copy()
        fresh[open_at] |= new
        at = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order] = at
        have *= 2
    return order, seeds


def repeated_windows(text: np.ndarray, length: int) -> np.ndarray:
    """True at places whose next ``length`` bytes hold no separator and begin elsewhere too."""
    n = len(text)
    order, seeds = suffix_array(text, length)
    bwt = text[order - 1]  # the first suffix wraps to the last byte, a separator
    by_symbol = np.argsort(bwt, kind="stable")
    by_symbol = by_symbol.astype(np.int32)  # narrow numbers: most of the work is looking things up
    step = np.empty(n, dtype=np.int32)  # backward step: where the suffix one byte longer stands
    step[by_symbol] = np.arange(n, dtype=np.int32)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    after = np.full(n, n, dtype=np.int32)  # next and last place with the same byte
    before = np.full(n, -1, dtype=np.int32)
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    within = bwt != SEPARATOR

    open_boundary = np.ones(n + 1, dtype=bool)  # boundary i: between suffixes i - 1 and i
    open_boundary[[0, n]] = False
    open_boundary[np.flatnonzero(seeds)] = False
    low = np.flatnonzero(seeds).astype(np.int32)
    high = np.append(low[1:], np.int32(n))
    depth = SEED
    while depth < length and len(low):
        size = high - low
        which = np.repeat(np.arange(len(low), dtype=np.int32), size)
        at = np.arange(len(which), dtype=np.int32) + np.repeat(low - (np.cumsum(size, dtype=np.int32) - size), size)
        usable = within[at]
        at, which = at[usable], which[usable]
        last = after[at] >= high[which]
        first = before[at] < low[which]
        # one first and one last place for every byte that precedes the interval, in the same order
        ends, end_of = step[at[last]] + 1, which[last]
        begins, begin_of = step[at[first]], which[first]
        if (end_of[1:] == end_of[:-1]).any():  # else no interval has two, and they are in order
            ends = ends[np.argsort(end_of.astype(np.int64) * (n + 1) + ends)]
            begins = begins[np.argsort(begin_of.astype(np.int64) * (n + 1) + begins)]
        fresh = open_boundary[ends]
        low, high = begins[fresh], ends[fresh]
        open_boundary[high] = False
        # several intervals may end at one boundary; one of them, the widest, goes on
        if len(high) > 1:
            pick = np.argsort(high.astype(np.int64) * (n + 1) + low)
            low, high = low[pick], high[pick]
            once = np.concatenate(([True], high[1:] != high[:-1]))
            low, high = low[once], high[once]
        depth += 1
    shared = open_boundary[:-1] | open_boundary[1:]
    out = np.zeros(n, dtype=bool)
    out[order[shared]] = True
    return out


def _index(length: int):
    def verdicts(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", kind="stable")
        key, copies, blocks = rows["key"].to_numpy(), rows["copies"].to_numpy(), rows["data"].tolist()
        sizes = np.array([len(b) + 1 for b in blocks])
        ends = np.cumsum(sizes)
        # keys are independent: a suffix array for as many as fit
        last_of_key = np.flatnonzero(np.append(key[1:] != key[:-1], True))
        cover: list[list[int]] = []
        first = 0
        for i in last_of_key:
            if i + 1 < len(blocks) and ends[i] - (ends[first] - sizes[first]) < INDEX_BYTES:
                continue
            some = blocks[first : i + 1]
            end = bytes([SEPARATOR])
            repeated = repeated_windows(np.frombuffer(end.join(some) + end, dtype=np.uint8), length)
            at = 0
            for block, n in zip(some, copies[first : i + 1], strict=True):
                cover.append([0, len(block)] if n > 1 else spans(repeated[at : at + len(block) - length + 1], length))
                at += len(block) + 1
            first = i + 1
        found = pd.DataFrame({"key": key, "content": rows["content"].to_numpy(), "cover": cover})
        return found[found["cover"].map(len) > 0]

    return verdicts


def spans(starts: np.ndarray, length: int) -> list[int]:
    """Bytes covered by windows from the marked places, as begin, end, begin, end, ..."""
    marked = np.flatnonzero(starts)
    if not len(marked):
        return []
    breaks = np.flatnonzero(np.diff(marked) > length)
    begin = marked[np.concatenate(([0], breaks + 1))]
    end = marked[np.concatenate((breaks, [len(marked) - 1]))] + length
    return np.column_stack([begin, end]).ravel().tolist()


def _cut_again(length: int, gram: int):
    """Blocks of hot keys cut with a longer gram."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = batch.column("data").to_pylist()
            bounds = np.cumsum([0] + [len(b) for b in blocks])
            data = b"".join(blocks)
            owner, start, size, key = cut_blocks(data, bounds, length, gram)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(_digests(data, start, size).view(np.int64)),
                    batch.column("copies").take(pa.array(owner)),
                    pa.array([data[a : a + n] for a, n in zip(start.tolist(), size.tolist(), strict=True)], pa.binary()),
                    batch.column("key").take(pa.array(owner)),
                    batch.column("content").take(pa.array(owner)),
                    pa.array((start - bounds[owner]).astype(np.int32)),
                ],
                names=["key", "content", "copies", "data", "of_key", "of_content", "at"],
            )

    return rows


def _pairs(cover: str) -> str:
    return f"transform(sequence(0, cast(size({cover}) / 2 as int) - 1), i -> struct({cover}[2 * i] as a, {cover}[2 * i + 1] as b))"


def _covers(blocks: DataFrame, length: int, grams: list[int], work: Workspace) -> DataFrame:
    """``key``, ``content`` and ``cover`` (repeated bytes as begin, end, ...) of distinct blocks ``(key, content, copies, data)``."""
    level = f"level{len(grams)}"
    rivals = work.put(blocks.groupBy("key").agg(F.count("*").alias("rivals")), f"{level}-keys")
    marked = blocks.join(rivals, "key")
    alone = marked.filter("rivals = 1 and copies > 1").select("key", "content", F.array(F.lit(0), F.length("data")).alias("cover"))
    calm = marked.filter(F.col("rivals").between(2, HOT_BLOCKS))
    tasks = partitions(calm.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0], TASK_BYTES)
    indexed = calm.groupBy(F.pmod(F.xxhash64("key"), F.lit(tasks)).alias("task")).applyInPandas(
        _index(length), "key long, content long, cover array<int>"
    )
    found = work.put(alone.unionByName(indexed), f"{level}-covers")
    if not grams or rivals.filter(F.col("rivals") > HOT_BLOCKS).isEmpty():
        return found
    schema = "key long, content long, copies long, data binary, of_key long, of_content long, at int"
    hot = marked.filter(F.col("rivals") > HOT_BLOCKS).select("key", "content", "copies", "data")
    pieces = work.put(hot.mapInArrow(_cut_again(length, grams[0]), schema), f"{level}-pieces")
    distinct = pieces.groupBy("key", "content").agg(F.sum("copies").alias("copies"), F.max("data").alias("data"))
    inner = _covers(work.put(distinct, f"{level}-distinct"), length, grams[1:], work)
    placed = pieces.select("key", "content", "of_key", "of_content", "at").join(inner, ["key", "content"])
    moved = F.flatten(F.collect_list(F.transform("cover", lambda x: x + F.col("at"))))  # at most a block's windows
    outer = placed.groupBy(F.col("of_key").alias("key"), F.col("of_content").alias("content")).agg(moved.alias("cover"))
    return found.unionByName(work.put(outer, f"{level}-outer"))


def repeated_ranges(documents: DataFrame, length: int, work: Workspace) -> DataFrame:
    """``t``, ``size`` (a text's hash and bytes) and ``ranges``: its repeated bytes as (a, b) pairs, unordered, perhaps overlapping."""
    rows = narrow(documents, "text").filter(F.octet_length("text") >= length).select(F.xxhash64("text").alias("t"), "text")
    blocks = work.put(rows.mapInArrow(_block_rows(length), BLOCK), "blocks")
    keys = blocks.groupBy("key").agg(F.count("*").alias("seen"), F.min("content").alias("lo"), F.max("content").alias("hi"))
    # written first: a join of two plain shuffles can be split where one key holds very many blocks
    keys = work.put(keys.filter("seen > 1").select("key", (F.col("lo") != F.col("hi")).alias("mixed")), "keys")
    blocks = work.put(blocks.join(keys, "key"), "shared")
    work.drop("blocks")

    place = F.struct("t", "size", "start", "n")
    distinct = blocks.filter("mixed").groupBy("key", "content").agg(F.count("*").alias("copies"), F.min(place).alias("at"))
    distinct = work.put(distinct.select("key", "content", "copies", "at.*"), "distinct")
    wanted = distinct.groupBy("t", "size").agg(
        F.collect_list(F.struct("key", "content", "copies", "start", "n")).alias("cuts")  # at most a text's blocks
    )
    once = Window.partitionBy("t", "size").orderBy("t")  # any row with the text will do
    texts = rows.withColumn("size", F.octet_length("text")).join(wanted, ["t", "size"]).withColumn("place", F.row_number().over(once))
    cut = texts.filter("place = 1").select(F.col("text").cast("binary").alias("text"), F.explode("cuts").alias("c"))
    cut = work.put(cut.select("c.key", "c.content", "c.copies", F.expr("substring(text, c.start + 1, c.n)").alias("data")), "cut")
    gram = min(GRAM, length)
    verdicts = _covers(cut, length, [(gram + length) // 2, length], work)

    whole = blocks.filter("not mixed").select("t", "size", F.col("start").alias("a"), (F.col("start") + F.col("n")).alias("b"))
    part = blocks.filter("mixed").join(verdicts, ["key", "content"]).select("t", "size", "start", F.explode(F.expr(_pairs("cover"))).alias("r"))
    part = part.select("t", "size", (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b")).alias("b"))
    found = whole.unionByName(part).distinct().groupBy("t", "size")
    ranges = work.put(found.agg(F.collect_list(F.struct("a", "b")).alias("ranges")), "ranges")  # at most a text's blocks
    work.drop("shared", "distinct", "cut")
    return ranges


def _merged(ranges) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _kept(text: bytes, removed: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for r in removed for x in r), len(text)]
    return b"".join(text[a:b] for a, b in zip(cuts[0::2], cuts[1::2], strict=True))


def deduplicate(documents: DataFrame, length: int = LENGTH, keep_bytes: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also begins anywhere else.

    Texts are taken as UTF-8 bytes; strings lie within one text and are judged on the input,
    so all copies go, the first included. Returns for every row ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256``; with ``keep_bytes``
    also ``kept`` (binary, since a cut may fall inside a character).

    NULL and empty texts have no bytes. Texts shorter than ``length`` lose nothing. Rows with equal
    texts are copies of each other, whatever their ids. An empty table gives no rows. Other
    columns are ignored.
    """
    if length < SEED:
        raise ValueError(f"length must be at least {SEED}")
    work = Workspace(documents.sparkSession, "substring")
    ranges = repeated_ranges(documents, length, work)
    rows = narrow(documents, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")
    ).withColumn("t", F.xxhash64(F.col("text").cast("string"))).withColumn("size", F.length("text"))
    joined = rows.join(ranges, ["t", "size"], "left").select("doc_id", "text", "ranges")

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if keep_bytes else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, str]] = []
            kept_texts = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                removed = _merged(found)
                kept = _kept(text, removed)
                kept_texts.append(kept if keep_bytes else None)
                out.append((len(text), len(text) - len(kept), len(removed), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([r[i] for r in out], pa.string() if i == 3 else pa.int64()) for i in range(4)]
            extra = [pa.array(kept_texts, pa.binary())] if keep_bytes else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, *extra], names=names)

    id_type = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if keep_bytes else "")
    )
