"""Near duplicates by fast similarity sketching, banding and exact verification.

Sketch: shingles are thrown into ``bins`` bins in rounds. In round ``i`` every shingle is
hashed to a random bin with the value (i, hash), and each bin keeps the least value it
sees, so later rounds only fill bins that are still empty. Should bins be left after
``bins`` rounds, round ``bins + b`` throws everything into bin ``b``: every coordinate is
filled. Two sets agree on a coordinate with their Jaccard similarity, and the number of
agreements is concentrated as if coordinates were independent.

Search: documents with equal shingle sets are one node. ``ROWS`` coordinates make a band;
nodes that share a band are tied to the least node of the band (a star, not all pairs), and
ties join nodes into clusters, which hold every pair that shares a band. Inside a cluster
pairs whose sketches agree too rarely are dismissed, the others are compared on their full
shingle sets until every pair is linked, joined through others, or refuted. A cluster too
large for one task is cut into parts, and each pair of parts is a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, partitions, text_key
from fiscora.llm.words import Words, mix, shingles, steps, utf8

ROWS = 6  # coordinates in a band
BANDS = 48  # a pair at similarity 0.8 shares none with a chance of 5e-7, at 0.85 of 2e-10
TASK_NODES = 2048

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _thrown(hashes: np.ndarray, turn: int) -> np.ndarray:
    return mix(hashes ^ mix(np.array([turn + 1], dtype=np.uint64) * _GOLD)[0])


def sketches(hashes: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """The sketch of every set (rows of ``bins`` values); zeros for an empty set.

    ``hashes[bounds[i]:bounds[i + 1]]`` is set ``i``. Values hold the round in which the
    coordinate was filled, so equal values mean the same shingle from the same throw.
    """
    sets = len(bounds) - 1
    table = np.full(sets * bins, _EMPTY, dtype=np.uint64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(sets), sizes)
    open_bins = np.where(sizes > 0, bins, 0)
    for turn in range(2 * bins):
        if len(hashes) == 0:
            break
        value = _thrown(hashes, turn)
        if turn < bins:
            place = owner * bins + ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        else:
            place = owner * bins + (turn - bins)
        empty = table[place] == _EMPTY
        place, value = place[empty], mix(value[empty])
        value[value == _EMPTY] = _EMPTY - np.uint64(1)
        np.minimum.at(table, place, value)
        if len(place):
            filled = np.unique(place) // bins
            np.subtract.at(open_bins, filled, 1)
            if not open_bins[filled].all():
                still = open_bins[owner] > 0
                hashes, owner = hashes[still], owner[still]
    table = table.reshape(sets, bins)
    table[sizes == 0] = 0
    return table


def _bands(table: np.ndarray) -> np.ndarray:
    parts = table.reshape(len(table), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * _GOLD, parts.shape[:2]).copy()
    for j in range(ROWS):
        out = mix(out + parts[:, :, j])
    return out.view(np.int64)


def _digest(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64 bits of every set: the sum of its mixed shingles."""
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes + _GOLD))))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)


def _sketch_rows(size: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for first, some in steps(texts):
                hashes, bounds = shingles(Words([t.lower() for t in some]), size)
                table = sketches(hashes, bounds, BANDS * ROWS)
                own = batch.slice(first, len(some))
                bands = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * BANDS, pa.array(_bands(table).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(own.column(c) for c in ("doc_id", "k1", "k2")),
                        pa.array(np.diff(bounds)),
                        pa.array(_digest(hashes, bounds)),
                        bands,
                        pa.array([row.tobytes() for row in (table & np.uint64(0xFF)).astype(np.uint8)], pa.binary()),
                    ],
                    names=["doc_id", "k1", "k2", "n_shingles", "node", "bands", "sketch"],
                )

    return rows


SKETCH = "doc_id long, k1 long, k2 long, n_shingles long, node long, bands array<long>, sketch binary"


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node``, ``root`` for every node of ``edges(a, b)``: the least node reachable.

    Every node points to its least neighbour, pointers are followed to their ends, and the graph
    is contracted to these ends: edges inside a tree are gone, and at least half of the nodes with them. Both
    the pointers' ends and the contractions take a number of rounds that grows with a logarithm. State
    is written each round; only counts come back.
    """
    left = work.put(edges.select("a", "b").filter("a <> b").distinct(), f"{name}-edges0")
    alone = edges.filter("a = b").select(F.col("a").alias("node"))
    labels, turn = None, 0
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        trees = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root"))
        trees = _followed(work.put(trees, f"{name}-trees{turn}"), work, f"{name}-trees{turn}")
        if labels is None:
            labels = trees.unionByName(alone.distinct().join(trees, "node", "left_anti").select("node", F.col("node").alias("root")))
        else:
            onward = trees.select(F.col("node").alias("root"), F.col("root").alias("further"))
            labels = labels.join(onward, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
        labels = work.put(labels, f"{name}-{turn}")
        first = trees.select(F.col("node").alias("a"), F.col("root").alias("x"))
        second = trees.select(F.col("node").alias("b"), F.col("root").alias("y"))
        between = left.join(first, "a").join(second, "b").filter("x <> y")
        turn += 1
        left = work.put(between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{name}-edges{turn}")
        if left.isEmpty():
            return labels


def _followed(pointers: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node``, ``root``: where the pointers from node to root end."""
    turn = 0
    while True:
        onward = pointers.select(F.col("node").alias("root"), F.col("root").alias("further"))
        turn += 1
        jumped = pointers.join(onward, "root").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved"))
        jumped = work.put(jumped, f"{name}-{turn}")
        pointers = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return pointers


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _linked(size: int, percent: int):
    """Compare the nodes of some clusters; returns links enough to join whatever is linked."""
    bins = BANDS * ROWS
    mean = bins * percent / 100
    least = int(mean - 6.5 * np.sqrt(mean * (1 - percent / 100)))  # a linked pair agrees less often with a chance below 1e-9

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        sets: dict[int, np.ndarray] = {}
        texts = utf8(rows["text"])
        for first, some in steps(texts):
            hashes, bounds = shingles(Words([t.lower() for t in some]), size)
            for i in range(len(some)):
                sets[first + i] = hashes[bounds[i] : bounds[i + 1]].copy()
        cluster, side, node = (rows[c].to_numpy() for c in ("cluster", "side", "node"))
        order = np.lexsort((node, cluster))
        cuts = np.flatnonzero(np.diff(cluster[order])) + 1
        for members in np.split(order, cuts):
            found.extend(_solve_cluster(members, rows["sketch"], sets, side, node, least, percent))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return solve


def _solve_cluster(members, sketch, sets, side, node, least: int, percent: int) -> list[tuple[int, int]]:
    table = np.stack([np.frombuffer(sketch.iloc[i], dtype=np.uint8) for i in members])
    sizes = np.array([len(sets[i]) for i in members])
    sides = side[members]
    joined = np.arange(len(members))
    crossing = len(set(sides.tolist())) > 1  # two parts of a large cluster: pairs within a part belong to its own task
    # the node nearest to the others first: most links run through it
    agree = (table == table[0]).sum(axis=1)
    for _ in range(2):
        agree = (table == table[int(np.argsort(-agree, kind="stable")[min(1, len(agree) - 1)])]).sum(axis=1)
    found = []
    for i in np.argsort(-agree, kind="stable"):
        other = joined != joined[i]
        if crossing:
            other &= sides != sides[i]
        # lengths first: a linked pair's differ little
        other &= (100 * sizes >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes)
        some = np.flatnonzero(other)
        if not len(some):
            continue
        score = (table[some] == table[i]).sum(axis=1)
        for j in some[score >= least][np.argsort(-score[score >= least], kind="stable")]:
            if joined[j] != joined[i] and _similar(sets[members[i]], sets[members[j]], percent):
                found.append((node[members[i]], node[members[j]]))
                joined[joined == joined[j]] = joined[i]
    return found


def _classes(documents: DataFrame, size: int, percent: int, work: Workspace) -> DataFrame:
    """Every document row: ``doc_id``, ``k1``, ``k2``, ``n_shingles``, ``node``, ``root``."""
    rows = narrow(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", text_key("text", 1))
    found = work.put(rows.mapInArrow(_sketch_rows(size), SKETCH), "sketches")
    # One row stands for each shingle set.
    sets = found.filter("n_shingles > 0").groupBy("node").agg(F.min(F.struct("k1", "k2")).alias("rep"))
    sets = work.put(sets.select("node", "rep.k1", "rep.k2"), "sets")

    banded = found.filter("n_shingles > 0").select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    shared = work.put(shared.select("band", "least"), "shared")
    ties = banded.join(shared, "band").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    clusters = components(work.put(ties.distinct(), "ties"), work, "cluster")

    # aggregates are written before they are joined: a join of two plain shuffles can be split at a hot key
    sized = work.put(clusters.groupBy("root").agg(F.count("*").alias("members")), "sized")
    total = clusters.count()
    tasks = partitions(total, TASK_NODES)
    parts = F.ceil(F.col("members") / TASK_NODES).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), parts).cast("int")
    # A small cluster goes whole to one task, with others; the parts of a large one meet two by two.
    shared_task = F.struct(
        F.lit(0).cast("long").alias("c"), F.pmod(F.xxhash64("cluster"), F.lit(tasks)).cast("int").alias("i"), F.lit(-1).alias("j")
    )
    own_task = F.struct(F.col("cluster").alias("c"), F.col("low").alias("i"), F.col("high").alias("j"))
    dealt = (
        clusters.join(sized, "root")
        .select("node", F.col("root").alias("cluster"), parts.alias("parts"), own.alias("own"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("task", F.when(F.col("parts") == 1, shared_task).otherwise(own_task))
        .select("node", "cluster", F.col("own").alias("side"), "task")
    )
    # A clustered set is read again from the row that stands for it. Only such rows' texts go to the tasks.
    sketch = found.select("k1", "k2", "sketch").join(sets, ["k1", "k2"]).dropDuplicates(["node"]).select("node", "k1", "k2", "sketch")
    wanted = work.put(dealt.join(sketch, "node"), "wanted")
    once = Window.partitionBy("k1", "k2", "task").orderBy("node")  # rows may repeat
    texts = rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).withColumn("place", F.row_number().over(once))
    texts = texts.filter("place = 1").select("task", "cluster", "side", "node", "sketch", "text")
    links = texts.groupBy("task").applyInPandas(_linked(size, percent), "a long, b long")
    links = work.put(links, "links")
    roots = components(links, work, "class")
    return found.select("doc_id", "k1", "k2", "n_shingles", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents whose distinct ``size``-word shingles have Jaccard similarity ``percent`` / 100 or more.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text with fewer words
    is one shingle. Returns for every row ``doc_id``, ``n_shingles``, ``component_id`` (least
    ``doc_id`` reachable over links, itself included) and ``kept`` (``doc_id = component_id``),
    and the row keys ``k1``, ``k2`` (hashes of id and text).

    Texts that are NULL, empty or blank have no shingles and are linked with nothing; their
    component is themselves. A row without an id joins its class but cannot name it: its
    ``component_id`` is NULL if no member has an id, and it is not ``kept``. Repeated rows
    appear once each. An empty table gives no rows. Other columns are ignored.
    """
    work = Workspace(documents.sparkSession, "near")
    found = _classes(documents, size, percent, work)
    with_class = work.put(found.select("doc_id", "k1", "k2", "n_shingles", "root"), "classes")
    least = work.put(with_class.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least")
    named = with_class.join(least, "root", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    )
    return named.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        "k1",
        "k2",
    )


def deduplicated(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each class, all columns: the row with the least id (rows without an id last).

    Texts without shingles are nobody's copy and stay. Rows equal in id and text are one document.
    """
    work = Workspace(documents.sparkSession, "near")
    found = work.put(_classes(documents, size, percent, work), "classes")
    best = found.filter("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2")).alias("m")
    )
    kept = best.select("m.k1", "m.k2").unionByName(found.filter("n_shingles = 0").select("k1", "k2")).distinct()
    kept = work.put(kept.select(F.col("k1").alias("r1"), F.col("k2").alias("r2")), "kept")
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    keyed = plain.withColumn("r1", F.xxhash64(doc_id.cast("long"), text)).withColumn("r2", text_key(text, 1))
    once = Window.partitionBy("r1", "r2").orderBy(doc_id)
    joined = keyed.join(kept, ["r1", "r2"]).withColumn("place", F.row_number().over(once)).filter("place = 1")
    return joined.drop("r1", "r2", "place").toDF(*names)
