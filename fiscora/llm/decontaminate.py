"""Benchmark decontamination by template canonicalisation, in SQL functions only.

Numbers, names (capitalised words) and units after a number become typed placeholders,
everything else is lower-cased. Windows of ``WINDOW`` template tokens are hashed and
joined with the windows of the benchmark, so a question with other numbers or names still
meets its original. A third stream folds names of several words, and a number and its unit,
into one placeholder, so that a value of another length shifts nothing. For the pairs that
meet, the names are compared: along one alignment each benchmark name must stand for one
document name and the reverse. A passage that swaps roles or mixes names is not the same
question. Numbers and units may change freely, since two may get the same new value.

Beside the templates run the words and numbers as they stand, without case: a literal copy is
found in any case, however short the item and however few its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fiscora.llm.common import Workspace, by_place, narrow, text_key

WINDOW = 8
LEAST_WINDOW = 5  # shorter templates identify nothing
LEAST_LITERALS = 4  # words that a template window must keep beside its placeholders
BROADCAST_HASHES = 1_000_000  # 8 bytes each
LEAST_WINDOWS = 3  # windows that must meet, or all of an item that has fewer

NUMBER, NAME, UNIT, MORE = "\ue000", "\ue001", "\ue002", "\ue003"  # private-use characters; MORE: a name after a name
NUMBER_PATTERN = r"\p{Nd}+(?:[.,]\p{Nd}+)*"
NAME_PATTERN = r"(?<![\p{L}\p{M}])\p{Lu}\p{Ll}[\p{L}\p{M}]*"
TOKEN_PATTERN = rf"{NUMBER_PATTERN}|[\p{{L}}\p{{M}}]+"

# Units recognised after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g gram grams kg lb lbs oz ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week "
    "weeks month months year years cent cents dollar dollars usd eur euro euros pound pounds percent degree degrees mph kmh"
).split()


def _marked(text: Column) -> Column:
    """A text with placeholders for its numbers and units."""
    marked = F.regexp_replace(text, NUMBER_PATTERN, f" {NUMBER} ")
    # without a digit there is neither a number nor a unit
    marked = F.regexp_replace(marked, rf"(?i)({NUMBER})[\s-]+(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{M}}])", f"$1 {UNIT} ")
    return F.when(text.rlike(r"\p{Nd}"), marked).otherwise(text)


def template(text: Column) -> Column:
    """Template tokens of a text."""
    marked = F.lower(F.regexp_replace(_marked(text), NAME_PATTERN, NAME))
    return F.array_remove(F.split(marked, rf"[^\p{{L}}\p{{M}}{NUMBER}-{UNIT}]+"), "")


def marked_template(text: Column) -> Column:
    """Template tokens, where a name after a name is marked as its continuation; in step with the template."""
    marked = F.regexp_replace(_marked(text), NAME_PATTERN, NAME)
    # the gap is bounded, since a look-behind has to be
    marked = F.regexp_replace(marked, rf"{NAME}(?<={NAME}[\s'’-]{{1,8}}{NAME})", MORE)
    return F.array_remove(F.split(F.lower(marked), rf"[^\p{{L}}\p{{M}}{NUMBER}-{MORE}]+"), "")


def folded(text: Column) -> Column:
    """Template tokens with one placeholder for names in a row, and for a number and its unit."""
    return F.filter(marked_template(text), lambda x: ~x.isin(MORE, UNIT))


def raw_tokens(text: Column) -> Column:
    """The words and numbers that the template tokens stand for, one for one."""
    return F.regexp_extract_all(text, F.lit(f"({TOKEN_PATTERN})"), F.lit(1))


def folded_case(text: Column) -> Column:
    """A text without case; ``ß`` equals ``SS``, a final sigma any other."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def literals(text: Column) -> Column:
    """Words and numbers as they stand, without case; in step with the template."""
    return raw_tokens(folded_case(text))


LITERAL, TEMPLATE, FOLDED = 0, 1, 2
STREAMS = {LITERAL: literals, TEMPLATE: template, FOLDED: folded}


def token_hashes(tokens: Column) -> Column:
    """64 bits of each token; what follows works on these alone."""
    return F.transform(tokens, lambda x: F.xxhash64(x))


def stream_hashes(text: Column) -> dict[int, Column]:
    """Token hashes of all streams from two passes over a text: the folded and the plain template come from the marked one."""
    more, unit, name = (F.xxhash64(F.lit(x)) for x in (MORE, UNIT, NAME))
    marked = F.col("marked_h")
    return {
        LITERAL: token_hashes(literals(text)),
        TEMPLATE: F.transform(marked, lambda x: F.when(x == more, name).otherwise(x)),
        FOLDED: F.filter(marked, lambda x: (x != more) & (x != unit)),
    }


def with_windows(frame: DataFrame, hashes: dict[int, str], kinds: list[tuple[int, int]]) -> DataFrame:
    """The frame with a column ``w{i}`` per ``(stream, size)``: hashes of all windows of that many tokens.

    Runs of 1, 2, 4, ... tokens are named from their halves, so a window is named by the two runs, the
    largest that fit, at its ends. Texts with fewer tokens have no window.
    """
    for stream in dict.fromkeys(stream for stream, _ in kinds):
        sizes = [size for s, size in kinds if s == stream]
        runs = {1: hashes[stream]}
        while 2 * max(runs) <= max(sizes) - 1:
            step, last = max(runs), runs[max(runs)]
            runs[2 * step] = f"r{stream}_{2 * step}"
            pairs = f"zip_with({last}, slice({last}, {step + 1}, greatest(size({last}) - {step}, 0)), (a, b) -> xxhash64(a, b))"
            frame = frame.withColumn(runs[2 * step], F.expr(pairs))
        for size in sizes:
            length = max(n for n in runs if n == 1 or n < size)
            run, count = runs[length], f"greatest(size({runs[1]}) - {size - 1}, 0)"
            ends = f"zip_with(slice({run}, 1, {count}), slice({run}, {size - length + 1}, {count}), (a, b) -> xxhash64({stream}, {size}, a, b))"
            frame = frame.withColumn(f"w{kinds.index((stream, size))}", F.expr(ends))
    return frame


def _keyed(documents: DataFrame) -> DataFrame:
    rows = narrow(documents, "doc_id", "text").filter(F.col("text").isNotNull())
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("k1"), text_key("text", 1).alias("k2"))


def _items(benchmark: DataFrame) -> DataFrame:
    items = narrow(benchmark, "item_id", "text").filter(F.col("text").isNotNull())
    return items.withColumn("item_key", text_key("text", 2))


def window_sizes(benchmark: DataFrame) -> list[tuple[int, int]]:
    """``(stream, size)`` of all windows that the benchmark asks for."""
    found = []
    for stream, tokens in STREAMS.items():
        least = 1 if stream == LITERAL else LEAST_WINDOW
        lengths = _items(benchmark).select(F.size(tokens(F.col("text"))).alias("n")).filter(F.col("n").between(least, WINDOW - 1))
        found += [(stream, n) for n in [WINDOW, *sorted(r["n"] for r in lengths.distinct().collect())]]  # fewer than WINDOW values
    return found


def benchmark_windows(benchmark: DataFrame, stream: int, size: int) -> DataFrame:
    """``item_id``, ``item_key``, ``at``, ``h``, ``needed`` for items that are matched with this window size."""
    items = _items(benchmark).select("item_id", "item_key", STREAMS[stream](F.col("text")).alias("t")).distinct()
    fits = F.size("t") >= size if size == WINDOW else F.size("t") == size
    named = with_windows(items.filter(fits).withColumn("hashes", token_hashes(F.col("t"))), {stream: "hashes"}, [(stream, size)])
    usable = named.select("item_id", "item_key", "t", F.posexplode("w0").alias("at", "h"))
    if stream != LITERAL:
        literal = F.expr(f"size(filter(slice(t, at + 1, {size}), x -> x not in ('{NUMBER}', '{NAME}', '{UNIT}')))")
        usable = usable.filter(literal >= LEAST_LITERALS)
    needed = usable.groupBy("item_id", "item_key").agg(F.least(F.count("*"), F.lit(LEAST_WINDOWS)).alias("needed"))
    # an item without an id is told apart by its text alone
    match = needed.select(F.col("item_id").alias("i"), F.col("item_key").alias("ik"), "needed")
    return usable.join(match, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("ik"))).select(
        "item_id", "item_key", "at", "h", "needed"
    )


def _met(rows: DataFrame, benchmark: DataFrame, work: Workspace) -> DataFrame:
    """Windows of documents that meet windows of items."""
    kinds = window_sizes(benchmark)
    wanted: DataFrame | None = None
    for i, (stream, size) in enumerate(kinds):
        some = benchmark_windows(benchmark, stream, size).select("*", F.lit(i).alias("kind"), F.lit(stream).alias("stream"), F.lit(size).alias("size"))
        wanted = some if wanted is None else wanted.unionByName(some)
    wanted = work.put(wanted, "windows")
    hashes = work.put(wanted.select("h").distinct(), "hashes")
    marked = rows.select("k1", "k2", "text", token_hashes(marked_template(F.col("text"))).alias("marked_h"))
    streams = marked.select("k1", "k2", *[h.alias(f"h{stream}") for stream, h in stream_hashes(F.col("text")).items()])
    hashed = with_windows(streams, {stream: f"h{stream}" for stream in STREAMS}, kinds)
    # all kinds in one array; the counts tell a window's place among its own kind
    counts, every = [F.size(f"w{i}").alias(f"n{i}") for i in range(len(kinds))], F.concat(*[f"w{i}" for i in range(len(kinds))])
    exploded = hashed.select("k1", "k2", *counts, F.posexplode(every).alias("place", "h"))
    # The corpus is probed where it lies while the benchmark's hashes are few; else both sides shuffle.
    few = hashes.count() <= BROADCAST_HASHES
    exploded = exploded.join(F.broadcast(hashes) if few else hashes, "h", "left_semi")
    before = sum((F.when(F.col("kind") > i, F.col(f"n{i}")).otherwise(0) for i in range(len(kinds))), F.lit(0))
    pairs = exploded.join(wanted, "h").withColumn("pos", F.col("place") - before)
    return pairs.select("k1", "k2", "item_id", "item_key", "needed", (F.col("pos") - F.col("at")).alias("diagonal"), "pos", "at", "stream", "size")


def _begins(marked: str, raw: str) -> Column:
    """The raw tokens that begin the folded ones, and the end."""
    return F.expr(f"filter(sequence(0, size({raw})), p -> coalesce(get({marked}, p) not in ('{MORE}', '{UNIT}'), true))")


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a benchmark passage, perhaps with other numbers, names or units.

    Returns one row per document, item and alignment that counts as a leak: ``doc_id``,
    ``item_id``, ``n_windows`` (windows that met), ``start`` (document token where the first
    of them begins), ``n_slots`` and ``n_changed`` (slots, and those whose value differs;
    0 for a literal copy), and the row keys ``k1``, ``k2`` (hashes of id and text).

    A literal copy counts in any case, with ``LEAST_WINDOWS`` windows or all of an item that has
    fewer; an item shorter than ``WINDOW`` is matched whole, even a single word. Templates need
    ``LEAST_WINDOW`` tokens, ``LEAST_LITERALS`` literal words in a window and names that agree.
    Alignments of folded templates are reported where no other alignment with the item overlaps.

    NULL texts and texts without words leak nothing. Rows equal in id and text are
    reported once. Benchmark items without words or numbers are ignored. An empty benchmark
    or corpus gives no rows. Other columns are ignored.
    """
    work = Workspace(documents.sparkSession, "decontaminate")
    rows = _keyed(documents)
    met = work.put(_met(rows, benchmark, work).distinct(), "met")

    # literal and template windows share their places, folded ones have their own
    fold = F.col("stream") == FOLDED
    group = ["k1", "k2", "item_id", "item_key", "fold", "diagonal"]
    literal = F.col("stream") == LITERAL
    enough = (
        met.withColumn("fold", fold)
        .groupBy(*group)
        .agg(
            F.min("pos").alias("first"),
            F.count(F.when(literal, 1)).alias("n_literal"),
            F.max(F.when(literal, F.col("needed"))).alias("needed_literal"),
            F.count(F.when(~literal, 1)).alias("n_template"),
            F.max(F.when(~literal, F.col("needed"))).alias("needed_template"),
            F.sort_array(F.collect_set(F.struct("at", "size"))).alias("spans"),  # at most the item's windows
        )
        .withColumn("n_windows", F.size("spans"))
        .withColumn("verbatim", F.coalesce(F.col("n_literal") >= F.col("needed_literal"), F.lit(False)))
        .filter("verbatim or n_windows >= needed_literal or n_template >= needed_template")
    )
    enough = work.put(enough, "enough")

    # Only documents that met enough windows are read again, for the values in their slots.
    # Their keys are written alone: narrow enough that texts rarely have to shuffle to meet them.
    texts = rows.join(work.put(enough.select("k1", "k2").distinct(), "keys"), ["k1", "k2"])
    texts = texts.select("k1", "k2", "doc_id", literals(F.col("text")).alias("raw"), marked_template(F.col("text")).alias("m"))
    texts = texts.dropDuplicates(["k1", "k2"]).select("*", _begins("m", "raw").alias("begins")).drop("m")
    items = _items(benchmark).select(
        F.col("item_id").alias("i"),
        F.col("item_key").alias("ik"),
        literals(F.col("text")).alias("item_raw"),
        template(F.col("text")).alias("t"),
        marked_template(F.col("text")).alias("m"),
    ).distinct().select("*", _begins("m", "item_raw").alias("item_begins")).drop("m")
    sides = enough.join(texts, ["k1", "k2"]).join(items, F.col("item_id").eqNullSafe(F.col("i")) & (F.col("item_key") == F.col("ik")))
    # where the words of each place begin, and the kind of each place
    sides = (
        sides.withColumn("b_at", F.when(F.col("fold"), F.col("item_begins")).otherwise(F.expr("sequence(0, size(item_raw))")))
        .withColumn("d_at", F.when(F.col("fold"), F.col("begins")).otherwise(F.expr("sequence(0, size(raw))")))
        .withColumn("places", F.expr("array_sort(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.size - 1)))))"))
        .withColumn("start", F.expr("get(d_at, cast(first as int))"))
        .withColumn("end", F.expr("get(d_at, cast(array_max(places) + diagonal + 1 as int))"))
    )
    slots = F.expr(f"filter(places, p -> get(t, get(b_at, p)) in ('{NUMBER}', '{NAME}', '{UNIT}'))")
    values = F.expr(
        "transform(slots, p -> struct("
        "slice(item_raw, get(b_at, p) + 1, get(b_at, p + 1) - get(b_at, p)) as b, "
        "slice(raw, get(d_at, cast(p + diagonal as int)) + 1, "
        "get(d_at, cast(p + diagonal as int) + 1) - get(d_at, cast(p + diagonal as int))) as d, "
        "get(t, get(b_at, p)) as kind))"
    )
    # names of as many words are compared word by word, others as a whole
    names = F.expr(
        f"array_distinct(flatten(transform(filter(values, v -> v.kind = '{NAME}'), v -> case when size(v.b) = size(v.d) "
        "then transform(v.b, (x, j) -> struct(x as x, get(v.d, j) as y)) "
        "else array(struct(array_join(v.b, ' ') as x, array_join(v.d, ' ') as y)) end)))"
    )
    compared = sides.withColumn("slots", slots).withColumn("values", values).withColumn("names", names)
    one_to_one = F.expr("size(array_distinct(names.x)) = size(names) and size(array_distinct(names.y)) = size(names)")
    found = compared.filter(F.col("verbatim") | one_to_one).select(
        "doc_id",
        "item_id",
        F.col("n_windows").cast("long").alias("n_windows"),
        F.col("start").cast("int").alias("start"),
        F.size("slots").alias("n_slots"),
        F.expr("size(filter(values, v -> v.b <> v.d))").alias("n_changed"),
        "k1",
        "k2",
        "item_key",
        "fold",
        "end",
    )
    # A folded alignment counts where no other of its item and document overlaps it.
    rank = Window.partitionBy("k1", "k2", "item_id", "item_key")
    earlier = F.max(F.when(~F.col("fold"), F.col("end"))).over(rank.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    later = F.min(F.when(~F.col("fold"), F.col("start"))).over(rank.orderBy("start").rangeBetween(0, Window.unboundedFollowing))
    found = found.withColumn("earlier", earlier).withColumn("later", later)
    alone = F.coalesce(F.col("earlier") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("later") >= F.col("end"), F.lit(True))
    return found.filter(~F.col("fold") | alone).drop("item_key", "fold", "end", "earlier", "later")


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that hold a benchmark passage."""
    leaks = contaminated(documents, benchmark).select(F.col("k1").alias("l1"), F.col("k2").alias("l2")).distinct()
    plain, names, at = by_place(documents)
    same = (F.xxhash64(at["doc_id"], at["text"]) == F.col("l1")) & (text_key(at["text"], 1) == F.col("l2"))
    return plain.join(leaks, same, "left_anti").toDF(*names)
