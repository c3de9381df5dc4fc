"""Line deduplication over suffixes of line-ID sequences.

A text is the sequence of its lines, a line's ID 128 bits of it. Prefix doubling ranks the
runs of 1, 2, 4, ... lines that begin at a line: a range sort over the pairs of ranks of the
halves gives the ranks of the runs twice as long, and only runs that occur more than once go
on. Places of one rank are an interval of the suffix array with at least that longest common
prefix; a run of any length is told by the ranks of the two overlapping runs of a power of
two that cover it, so nothing but a line's ID is a hash.

A run counts as soon as it has ``min_words`` words. The shortest such runs that begin, and
that end, at each line cover every maximal repeated run exactly, so it is enough to name
these: where one occurs earlier, its lines are a later copy and go.

Lines are shuffled as hashes and numbers; the text moves once, to be cut.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, text_key
from fiscora.llm.packing import WORD

MIN_WORDS = 1

DOC = ("k1", "k2")  # hashes of id and text
RUN = ("front", "back", "n")  # ranks of the runs at both ends, and the lines


def shortest_runs(lines: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """Shortest runs of consecutive ``lines`` with ``min_words`` words from, and up to, each line: (begin, count)."""
    found: set[tuple[int, int]] = set()
    lines_, words_ = np.asarray(lines), np.asarray(words)
    for stretch in np.split(np.arange(len(lines_)), np.flatnonzero(np.diff(lines_) != 1) + 1):
        total = np.concatenate(([0], np.cumsum(words_[stretch])))
        count = len(stretch)
        # first end with enough words after each begin; last begin with enough words before each end
        end = np.searchsorted(total, total[:-1] + min_words, side="left")
        begin = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        base = int(lines_[stretch[0]])
        found.update((base + a, int(e) - a) for a, e in enumerate(end.tolist()) if e <= count)
        found.update((base + int(b), e + 1 - int(b)) for e, b in enumerate(begin.tolist()) if b >= 0)
    return sorted((b, max(1, n)) for b, n in found)


def _runs_of(min_words: int):
    @F.pandas_udf("array<struct<a:int,n:int>>")
    def runs(rows: pd.Series) -> pd.Series:
        return pd.Series([shortest_runs([r["line"] for r in some], [r["words"] for r in some], min_words) for some in rows.map(list)])

    return runs


def _rows(documents: DataFrame) -> DataFrame:
    rows = narrow(documents, "doc_id", "text").filter(F.col("text").isNotNull())
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), text_key("text", 1).alias("k2"))


def _repeated(level: DataFrame, key: list[str], work: Workspace, name: str) -> DataFrame:
    """The places whose ``key`` occurs more than once, with its rank as ``name``."""
    often = level.groupBy(*key).agg(F.count("*").alias("seen")).filter("seen > 1").select(*key)
    # Numbers given after a sort grow with the keys. The keys are distinct, so a task that runs again gives the same.
    # Written first: a join of two plain shuffles can be split where one key holds very many places.
    ranked = work.put(often.orderBy(*key).select(*key, F.monotonically_increasing_id().alias("rank")), f"{name}-ranks")
    return work.put(level.join(ranked, key).drop(*key).withColumnRenamed("rank", "name"), name)


def later_copies(documents: DataFrame, min_words: int, work: Workspace) -> DataFrame:
    """``k1``, ``k2``, ``removed``: numbers of the lines that repeat an earlier run, in order."""
    position = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2")
    lines = (
        _rows(documents)
        .select("doc_id", *DOC, F.posexplode(F.split("text", "\n")).alias("line", "text"))
        .select(
            "doc_id", *DOC, "line", text_key("text", 2).alias("id1"), text_key("text", 3).alias("id2"), F.regexp_count("text", F.lit(WORD)).alias("words")
        )
        .dropDuplicates([*DOC, "line"])  # rows equal in id and text: see deduplicate
    )
    level = _repeated(work.put(lines, "lines"), ["id1", "id2"], work, "level0")
    work.drop("lines")
    gathered = level.groupBy(*DOC).agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("line", "words"))).alias("rows"))
    runs = gathered.select("doc_id", *DOC, F.explode(_runs_of(min_words)("rows")).alias("r")).select(
        "doc_id", *DOC, F.col("r.a").alias("a"), F.col("r.n").alias("n"), F.floor(F.log2(F.col("r.n") + 0.5)).cast("int").alias("k")
    )
    runs = work.put(runs, "runs")
    deepest = runs.agg(F.max("k")).first()[0] or 0

    # Prefix doubling, as deep as the longest of these runs asks for.
    names = level.select(*DOC, "line", F.lit(0).alias("k"), "name")
    order = Window.partitionBy(*DOC).orderBy("line")
    for k in range(1, deepest + 1):
        step = 1 << (k - 1)
        pairs = level.select(
            *DOC, "line", "name", F.lead("name", step).over(order).alias("next"), F.lead("line", step).over(order).alias("next_line")
        ).filter(F.col("next_line") == F.col("line") + step)
        pairs = work.put(pairs.drop("next_line"), f"pairs{k}")
        level = _repeated(pairs, ["name", "next"], work, f"level{k}")
        names = names.unionByName(level.select(*DOC, "line", F.lit(k).alias("k"), "name"))

    half = F.expr("a + n - shiftleft(1, k)")
    front = names.select(*DOC, F.col("line").alias("a"), "k", F.col("name").alias("front"))
    back = names.select(*DOC, F.col("line").alias("b"), "k", F.col("name").alias("back"))
    named = runs.join(front, [*DOC, "a", "k"]).withColumn("b", half).join(back, [*DOC, "b", "k"])
    named = work.put(named.select("doc_id", *DOC, "a", *RUN), "named")
    place = F.struct(position.alias("d"), "a")
    first = named.groupBy(*RUN).agg(F.min(place).alias("first"), F.count("*").alias("seen")).filter("seen > 1").select(*RUN, "first")
    first = work.put(first, "first")
    copies = named.join(first, list(RUN)).filter(place > F.col("first"))
    removed = (
        copies.select(*DOC, F.explode(F.expr("sequence(a, a + n - 1)")).alias("line"))
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))  # at most a text's lines
    )
    removed = work.put(removed, "removed")
    work.drop("runs", "named", *(f"level{k}" for k in range(deepest + 1)))
    return removed


def _cut(keyed: DataFrame, removed: DataFrame, min_words: int) -> DataFrame:
    """Rows ``(k1, k2, text, ...)`` with ``n_lines``, ``removed`` and ``kept``."""
    again = F.row_number().over(Window.partitionBy(*DOC).orderBy(*DOC)) > 1
    gone = F.when(
        again & (F.regexp_count("text", F.lit(WORD)) >= min_words), F.sequence(F.lit(0), F.size("lines") - 1)
    ).otherwise(F.coalesce("removed", F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "removed")
    left = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    return (
        keyed.join(removed, list(DOC), "left")
        .withColumn("lines", F.split("text", "\n"))
        .withColumn("removed", gone)
        .withColumn("n_lines", F.coalesce(F.greatest(F.size("lines"), F.lit(0)), F.lit(0)))
        .withColumn("kept", F.when(F.size("removed") == 0, F.col("text")).otherwise(left))
        .drop("lines")
    )


def deduplicate(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Delete later copies of repeated runs of whole lines.

    A line goes if it lies in a run of consecutive lines of one text that has ``min_words`` words
    or more and occurs earlier, in the same text or another. Earlier: by ``doc_id`` (NULL last;
    equal ids in the order of a hash), then by line. Returns for every row ``doc_id``,
    ``n_lines``, ``n_removed``, ``n_runs`` (stretches of removed lines) and ``kept`` (what is left).

    Lines are separated by line feeds and compared by 128 bits of their bytes. Texts below ``min_words``
    and lines repeated alone with fewer words stay; at 1, only blank runs do. A NULL text has no lines and stays NULL. Of
    rows equal in id and text, all but one are later copies as a whole. An empty table gives
    no rows. Other columns are ignored.
    """
    work = Workspace(documents.sparkSession, "lines")
    removed = later_copies(documents, min_words, work)
    keyed = narrow(documents, "doc_id", "text").withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", text_key("text", 1))
    return _cut(keyed, removed, min_words).select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.size("removed").cast("long").alias("n_removed"),
        F.expr("size(filter(removed, (x, i) -> i = 0 or get(removed, i - 1) <> x - 1))").cast("long").alias("n_runs"),
        "kept",
    )


def cleaned(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents, all columns, with the kept text; one that consisted of later copies only is gone."""
    work = Workspace(documents.sparkSession, "lines")
    removed = later_copies(documents, min_words, work)
    names = documents.columns
    plain = documents.toDF(*[f"c{i}" for i in range(len(names))])
    doc_id, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    keyed = plain.withColumn("k1", F.xxhash64(doc_id, text)).withColumn("k2", text_key(text, 1)).withColumn("text", text)
    cut = _cut(keyed, removed, min_words).filter((F.size("removed") == 0) | (F.trim("kept") != ""))
    columns = [F.col("kept") if name == "text" else F.col(f"c{i}") for i, name in enumerate(names)]
    return cut.select(*columns).toDF(*names)
