"""Sharding by extendible hashing.

Every row has a hash of 60 bits. A directory is indexed by the leading bits of that
hash; a bucket whose rows exceed the byte limit is split on one more bit, all others
stay as they are. Buckets are therefore prefixes of different length ("local depth"),
no prefix of another, and together they cover every hash.

The directory is found from sums, never from rows: sizes are added up per fine cell
(map-side combined), rolled up to every shorter prefix, and a prefix becomes a bucket
where it fits and its parent does not. Cells that are still too large at the finest
depth of a round go through another round with more bits, which reads only their rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, by_place, narrow

HASH_BITS = 64  # of which the last four are 0
DIGITS = 15  # hexadecimal digits of the digest that make the hash
STEP_BITS = 12  # bits by which one round refines

BUCKET = ("depth", "prefix", "shard_bytes", "shard_rows")


def prefix_of(hashed: str, depth: int) -> Column:
    """The leading ``depth`` bits of a 64-bit hash, as a number. Depth 0 gives 0."""
    return F.expr(f"shiftrightunsigned({hashed}, {HASH_BITS - depth})") if depth else F.lit(0).cast("long")


def bits(prefix: str, depth: str) -> Column:
    """A prefix written out, ``""`` for depth 0."""
    return F.expr(f"right(lpad(bin({prefix}), {HASH_BITS}, '0'), {depth})")


def place(sized: DataFrame, limit: int, work: Workspace) -> DataFrame:
    """Rows ``(h, n_bytes, ...)`` with the bucket they fall into (``BUCKET``)."""
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    placed: list[DataFrame] = []
    rows, start = sized, 0
    while True:
        fine = min(HASH_BITS, start + STEP_BITS)
        rows = rows.withColumn("cell", prefix_of("h", fine))
        cells = work.put(
            rows.groupBy("cell").agg(
                F.sum("n_bytes").alias("size"), F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
            ),
            f"cells{fine}",
        )
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(start), F.lit(fine)))).withColumn(
            "prefix", F.expr(f"shiftrightunsigned(cell, {fine} - depth)")
        )
        sums = work.put(
            levels.groupBy("depth", "prefix").agg(
                F.sum("size").alias("shard_bytes"),
                F.sum("n").alias("shard_rows"),
                # one hash value only: no further bit can split it
                ((F.sum("size") <= limit) | (F.min("lo") == F.max("hi"))).alias("final"),
            ),
            f"sums{fine}",
        )
        parents = sums.filter(~F.col("final")).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        final = sums.filter("final").withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
        buckets = final.join(parents, ["depth", "parent"], "left_semi").select(*BUCKET)
        if start == 0:
            buckets = buckets.unionByName(final.filter("depth = 0").select(*BUCKET))
        cell_bucket = work.put(levels.select("cell", "depth", "prefix").join(buckets, ["depth", "prefix"]), f"map{fine}")
        placed.append(rows.join(cell_bucket, "cell").drop("cell"))
        if fine == HASH_BITS or sums.filter(~F.col("final") & (F.col("depth") == fine)).isEmpty():
            return reduce(DataFrame.unionByName, placed)
        rows = work.put(rows.join(cell_bucket, "cell", "left_anti").drop("cell"), f"rows{fine}")
        start = fine


def row_hash(doc_id: Column, text: Column) -> Column:
    """The first bits of an MD5 of id and text, leading ones first."""
    row = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.shiftleft(F.conv(F.left(F.md5(row), F.lit(DIGITS)), 16, 10).cast("long"), HASH_BITS - 4 * DIGITS)


def sized_rows(documents: DataFrame) -> DataFrame:
    """``doc_id``, the hash of id and text (so neither a hot id nor copies of a text pile up), UTF-8 length."""
    return narrow(documents, "doc_id", "text").select(
        "doc_id",
        row_hash(F.col("doc_id"), F.col("text")).alias("h"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )


def assign(documents: DataFrame, limit: int) -> DataFrame:
    """The shard of every document row.

    Returns ``doc_id``, ``n_bytes`` (UTF-8 length of the text, NULL text 0), ``shard`` (the
    prefix as bits, ``""`` when one bucket holds everything), ``depth``, ``shard_bytes``,
    ``shard_rows`` and ``oversize``.

    Rows are never cut: a document longer than the limit is split off from all others and
    marked ``oversize``; so are wholly equal rows that exceed the limit together, since
    equal rows share a shard. An empty table has no shards. NULL ids and NULL texts are
    hashed like any value. Other columns are ignored.
    """
    work = Workspace(documents.sparkSession, "sharding")
    return place(work.put(sized_rows(documents), "sized"), limit, work).select(
        "doc_id",
        "n_bytes",
        bits("prefix", "depth").alias("shard"),
        F.col("depth").cast("int").alias("depth"),
        "shard_bytes",
        "shard_rows",
        (F.col("shard_bytes") > limit).alias("oversize"),
    )


def write_shards(documents: DataFrame, path: str, limit: int) -> None:
    """Write every row with all its columns, one folder ``shard=b<bits>`` per shard.

    Where a column has that name already, in any case, the folders' name gets a ``_`` at its end.
    """
    work = Workspace(documents.sparkSession, "sharding")
    placed = place(work.put(sized_rows(documents).drop("doc_id"), "sized"), limit, work)
    shards = placed.select("h", F.concat(F.lit("b"), bits("prefix", "depth")).alias("folder")).distinct()
    plain, names, at = by_place(documents)
    folder = "shard"
    while folder in {n.lower() for n in names}:
        folder += "_"
    keyed = plain.withColumn("h", row_hash(at["doc_id"], at["text"]))
    # a shard is bounded by the limit, so one task can write it
    rows = keyed.join(shards, "h").drop("h").repartition("folder").toDF(*names, folder)
    rows.write.mode("overwrite").partitionBy(folder).parquet(path)
