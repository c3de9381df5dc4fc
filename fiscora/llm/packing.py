"""Packing into optimal length buckets.

A document becomes sequences of at most ``context`` tokens; nothing is cut off. The
histogram of sequence lengths over the whole corpus (at most ``context`` rows) goes to
the driver, where dynamic programming picks the bucket limits with the least padding:

    best[b][j] = min over i < j of best[b-1][i] + sum over i < t <= j of n_t * (len_j - len_t)

The inner minimum is over lines in ``len_j`` with falling slopes, so a lower envelope
solves one bucket in linear time. Inside a bucket every sequence is padded to the bucket
limit and batches take as many sequences as the token budget allows. Sequences are
numbered by (hash slot, rank in the slot): slots are small and their offsets come from
counts, so a bucket with a third of all rows is not numbered by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, narrow, partitions

CONTEXT = 2048
BUCKETS = 16
BATCH_TOKENS = 65_536
SLOT_ROWS = 20_000
WORD = r"[^\x20\x09-\x0D]+"


def bucket_limits(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Limits of at most ``buckets`` buckets with the least total padding.

    ``histogram`` holds (length, count). The last limit is the greatest length. Among
    equally good choices the smaller earlier limits win. No lengths give no limits.
    """
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    rows = sorted((length, count) for length, count in histogram if count > 0)
    size = len(rows)
    if size == 0:
        return []
    lengths = [0] + [r[0] for r in rows]
    counts, tokens = [0], [0]  # running sums
    for length, count in rows:
        counts.append(counts[-1] + count)
        tokens.append(tokens[-1] + count * length)
    best = [None] + [lengths[j] * counts[j] - tokens[j] for j in range(1, size + 1)]
    choice = [[0] * (size + 1)]
    for _ in range(1, min(buckets, size)):
        new: list = [None] * (size + 1)
        chosen = [0] * (size + 1)
        hull: list[tuple[int, int, int]] = []  # (slope, intercept, i), slopes fall
        head = 0
        for j in range(2, size + 1):
            i = j - 1
            line = (-counts[i], best[i] + tokens[i], i) if best[i] is not None else None
            if line:
                while len(hull) - head >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (line[1] - b1) * (m1 - m2) <= (b2 - b1) * (m1 - line[0]):
                        hull.pop()
                    else:
                        break
                hull.append(line)
            x = lengths[j]
            while len(hull) - head >= 2 and hull[head + 1][0] * x + hull[head + 1][1] < hull[head][0] * x + hull[head][1]:
                head += 1
            if len(hull) > head:
                slope, intercept, i = hull[head]
                new[j] = slope * x + intercept + x * counts[j] - tokens[j]
                chosen[j] = i
        if new[size] is None or new[size] >= best[size]:
            break
        # keep the better of both, so that a prefix may use fewer buckets
        for j in range(1, size + 1):
            if new[j] is None or new[j] >= best[j]:
                new[j], chosen[j] = best[j], -1
        best = new
        choice.append(chosen)
    limits, j, level = [], size, len(choice) - 1
    while j > 0:
        while level > 0 and choice[level][j] == -1:
            level -= 1
        limits.append(lengths[j])
        j = choice[level][j]
        level -= 1
    return limits[::-1]


def sequences(documents: DataFrame, context: int) -> DataFrame:
    """``doc_id``, ``piece`` (from 0), ``n_tokens``: whole texts as pieces of at most ``context`` words."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return (
        narrow(documents, "doc_id", "text")
        .select("doc_id", words.cast("long").alias("words"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("words") / context) - 1, F.lit(0)))))
        .withColumn("n_tokens", F.least(F.col("words") - F.col("piece") * context, F.lit(context).cast("long")))
        .select("doc_id", "piece", "n_tokens")
    )


def pack(
    documents: DataFrame, context: int = CONTEXT, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS
) -> DataFrame:
    """Batches for every sequence of every document.

    Tokens are words (runs of other than ASCII white space). Returns ``doc_id``, ``piece``,
    ``n_tokens``, ``bucket`` (from 0), ``bucket_len``, ``batch`` (from 0 inside the bucket),
    ``slot`` (place in the batch), ``padding``. A batch holds ``batch_tokens / bucket_len``
    sequences, at least one; all batches of a bucket are full but the last.

    NULL, empty and blank texts are one sequence of length 0 in the first bucket; a bucket of
    length 0 counts as length 1. Repeated rows are packed once each. An empty table gives no
    rows. Other columns are ignored.
    """
    if context < 1 or batch_tokens < 1:
        raise ValueError("context and batch_tokens must be positive")
    spark = documents.sparkSession
    work = Workspace(spark, "packing")
    rows = work.put(sequences(documents, context), "sequences")
    histogram = [(r[0], r[1]) for r in rows.groupBy("n_tokens").count().collect()]  # at most context + 1 rows
    limits = bucket_limits(histogram, buckets) or [0]
    number = F.lit(len(limits) - 1)
    length = F.lit(limits[-1])
    for i in range(len(limits) - 2, -1, -1):
        number = F.when(F.col("n_tokens") <= limits[i], F.lit(i)).otherwise(number)
        length = F.when(F.col("n_tokens") <= limits[i], F.lit(limits[i])).otherwise(length)
    slots = partitions(sum(n for _, n in histogram), SLOT_ROWS)
    dealt = rows.select(
        "doc_id",
        "piece",
        "n_tokens",
        number.cast("int").alias("bucket"),
        length.cast("long").alias("bucket_len"),
        # equal rows differ in nothing; the stored place spreads them
        F.pmod(F.xxhash64("doc_id", "piece", F.spark_partition_id()), F.lit(slots)).alias("part"),
    )
    dealt = work.put(dealt, "dealt")
    before = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("bucket", "part").agg(F.count("*").alias("n")).select(
        "bucket", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    place = Window.partitionBy("bucket", "part").orderBy("doc_id", "piece", "n_tokens")
    numbered = dealt.withColumn("rank", F.row_number().over(place)).join(offsets, ["bucket", "part"])
    width = F.greatest(F.col("bucket_len"), F.lit(1))
    capacity = F.greatest(F.floor(F.lit(batch_tokens) / width), F.lit(1))
    index = F.col("offset") + F.col("rank") - 1
    return numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        "bucket_len",
        F.floor(index / capacity).alias("batch"),
        F.pmod(index, capacity).alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"),
    )
