"""Every corpus operator against a plain version: on the smallest tables, and on odd rows."""

import hashlib
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscora.llm import decontaminate, hmm, line_dedup, near_dedup, packing, quality, queries, sharding, substring_dedup, topk, toxicity
from fiscora.llm.labels import fold

from . import plain

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables are not here")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(plain.odd_rows(), plain.DOCUMENTS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], plain.DOCUMENTS)


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def same(found, expected):
    assert Counter(found) == Counter(expected)


def tuples(frame, *names):
    return [tuple(r[n] for n in names) for r in frame.select(*names).collect()]


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.EXPECTED))
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found, cursor = queries.QUERIES[name](spark, DATA), connection.execute(queries.EXPECTED[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    same(tuples(found, *columns), cursor.fetchall())


# 1: substring deduplication

SUBSTRING = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@needs_tables
@pytest.mark.parametrize("hot", [substring_dedup.HOT_BLOCKS, 1])
def test_op1_matches_plain(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_BLOCKS", hot)
    same(tuples(queries.op1_substring_dedup(spark, DATA), *SUBSTRING), plain.substring_rows(pairs(documents(spark)), 200))


@pytest.mark.parametrize("length", [40, 33, 8])
def test_op1_odd_rows(odd, length):
    found = substring_dedup.deduplicate(odd.filter("doc_id is null or doc_id not in (12, 13)"), length)
    same(tuples(found, *SUBSTRING), plain.substring_rows([(i, t) for i, t, *_ in plain.odd_rows() if i not in (12, 13)], length))


def test_op1_long_texts_are_cut_in_pieces(spark, monkeypatch):
    rows = [(i, t) for i, t, *_ in plain.odd_rows() if i in (12, 13)]
    frame = spark.createDataFrame([(*r, *plain.FILL) for r in rows], plain.DOCUMENTS)
    monkeypatch.setattr(substring_dedup, "PIECE_BYTES", 5000)
    found = substring_dedup.deduplicate(frame, keep_bytes=True)
    same(tuples(found, *SUBSTRING), plain.substring_rows(rows, 200))
    for r in found.collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]


def test_op1_self_overlap_and_empty(spark, nothing):
    rows = [(1, "ab" * 300), (2, "x" * 199), (3, "y" * 200), (4, "z" * 201)]
    same(tuples(substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")), *SUBSTRING), plain.substring_rows(rows, 200))
    assert substring_dedup.deduplicate(nothing).count() == 0


def test_repeated_windows_match_plain():
    random = np.random.default_rng(3)
    for alphabet, size, length in ((2, 400, 12), (3, 700, 9), (2, 300, 30)):
        blocks = [bytes(random.integers(97, 97 + alphabet, size=size // 4).astype(np.uint8)) for _ in range(4)]
        text = np.frombuffer(b"\xff".join(blocks) + b"\xff", dtype=np.uint8)
        windows = [bytes(text[i : i + length]) for i in range(len(text))]
        seen = Counter(w for w in windows if len(w) == length and b"\xff" not in w)
        found = substring_dedup.repeated_windows(text, length)
        for i, w in enumerate(windows):
            if len(w) == length and b"\xff" not in w:
                assert found[i] == (seen[w] > 1)


# 2: near duplicates

NEAR = ("doc_id", "n_shingles", "component_id", "kept")


@needs_tables
@pytest.mark.parametrize("size,percent,nodes", [(3, 85, near_dedup.TASK_NODES), (5, 80, near_dedup.TASK_NODES), (3, 85, 2)])
def test_op2_matches_plain(spark, monkeypatch, size, percent, nodes):
    monkeypatch.setattr(near_dedup, "TASK_NODES", nodes)
    found = near_dedup.near_duplicates(documents(spark), size, percent)
    same(tuples(found, *NEAR), plain.near_classes(pairs(documents(spark)), size, percent))


def test_op2_odd_rows(odd, nothing):
    found = near_dedup.near_duplicates(odd, 3, 80)
    same(tuples(found, *NEAR), plain.near_classes([(i, t) for i, t, *_ in plain.odd_rows()], 3, 80))
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_op2_keeps_one_of_each_class(odd, nothing):
    kept = near_dedup.deduplicated(odd, 3, 80)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # blank texts stay, equal rows count once, copies and near copies leave the least id
    assert ids == Counter([1, 3, 4, 5, 6, 7, 9, 12, 14, 16, 17, None])
    assert near_dedup.deduplicated(nothing).count() == 0


def test_op2_chain_of_near_copies_is_one_class(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[i * 3 :] + [f"v{j}" for j in range(i * 3)])) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same(tuples(near_dedup.near_duplicates(frame, 3, 85), *NEAR), plain.near_classes(rows, 3, 85))
    monkeypatch.setattr(near_dedup, "TASK_NODES", 4)
    same(tuples(near_dedup.near_duplicates(frame, 3, 85), *NEAR), plain.near_classes(rows, 3, 85))


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5])
def test_shingles_of_few_words_in_all(size):
    for n in range(6):
        text = " ".join(f"w{i}" for i in range(n))
        hashes, bounds = near_dedup.shingles(near_dedup.Words([text.encode()]), size)
        assert len(hashes) == len(set(hashes.tolist())) == len(plain.shingle_set(text, size)) and bounds.tolist() == [0, len(hashes)]


def test_op2_one_short_row(spark):
    for n in (2, 3):  # fewer than size - 1
        rows = [(1, " ".join("abcde"[:n]))]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        same(tuples(near_dedup.near_duplicates(frame, 5, 80), *NEAR), plain.near_classes(rows, 5, 80))


def test_sketch_fills_every_coordinate_and_estimates():
    random = np.random.default_rng(5)
    a = random.integers(0, 2**63, size=300).astype(np.uint64)
    b = np.concatenate([a[:270], random.integers(0, 2**63, size=30).astype(np.uint64)])
    one = a[:1]
    joined = np.concatenate([a, b, one])
    table = near_dedup.sketches(joined, np.array([0, 300, 600, 601, 601]), 288)
    assert (table[:3] != near_dedup._EMPTY).all() and (table[3] == 0).all()
    assert abs((table[0] == table[1]).mean() - 270 / 330) < 0.1


# 3: top-k

TOP = ("query_id", "rank", "vec_id", "score")


@needs_tables
@pytest.mark.parametrize("vectors,asked", [(topk.VECTOR_BLOCK, topk.QUERY_BLOCK), (40, 1)])
def test_op3_matches_sql(spark, monkeypatch, vectors, asked):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", vectors)
    monkeypatch.setattr(topk, "QUERY_BLOCK", asked)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{DATA}/embeddings.parquet'")
    same(tuples(queries.op3_topk(spark, DATA), *TOP), connection.execute(queries.EXPECTED["op3_topk"]).fetchall())


def test_op3_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = {0: [0.5, -1.0, 0.25], 1: [0.5, -1.0, 0.25], 2: [0.0, 0.0, 0.0], 3: [-3.0, 2.0, 1.0], 50: [1.0, 1.0, 1.0], 100: [1.0, 2.0], 101: [3.0, 4.0]}
    bad = [(5, None), (6, [None, 1.0, 1.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows = [(i, v, 1, 2.0) for i, v in [*good.items(), *bad, (0, good[0])]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double")
    same(tuples(topk.top_k(frame, F.col("vec_id") % 50 == 0, 3), *TOP), plain.top_rows([*good.items(), (0, good[0])], 50, 3))
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    empty_vectors = spark.createDataFrame([(0, []), (1, []), (2, [])], "vec_id long, embedding array<float>")
    same(tuples(topk.top_k(empty_vectors, F.col("vec_id") == 0, 5), *TOP), [(0, 1, 1, 0), (0, 2, 2, 0)])


def test_op3_ties_and_huge_components(spark):
    tied = {i: [1.0, 0.0] for i in range(8)}
    frame = spark.createDataFrame(list(tied.items()), "vec_id long, embedding array<float>")
    same(tuples(topk.top_k(frame, F.col("vec_id") == 0, 5), *TOP), plain.top_rows({k: v for k, v in tied.items()}, 1000, 5))
    huge = {0: [2.0**30, 3.0], 1: [2.0**20, -5.0], 2: [-(2.0**21), 7.0]}
    frame = spark.createDataFrame(list(huge.items()), "vec_id long, embedding array<double>")
    held = [(q, rank, i, max(-(2**63), min(2**63 - 1, score))) for q, rank, i, score in plain.top_rows(huge, 1000, 5)]
    same(tuples(topk.top_k(frame, F.col("vec_id") == 0, 5), *TOP), held)


# 4: decontamination

QUESTION = "Farmer Tom has 12 apples and gives 5 apples to each of his neighbours before he walks 3 km home to Anna through the dark wood"


def leaks(spark, texts, items):
    docs = spark.createDataFrame([(i, t, *plain.FILL) for i, t in texts], plain.DOCUMENTS)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, h string, doc_id int")
    return docs, bench


def test_op4_finds_changed_numbers_and_names(spark):
    changed = QUESTION.replace("Tom", "Max").replace("12", "1,044").replace("5", "7").replace("3 km", "9 miles").replace("Anna", "Berta")
    swapped = "Farmer Tom has 12 apples and Tom gives 12 apples to each of the neighbours before Tom goes home"
    mixed = swapped.replace("Farmer Tom has 12", "Farmer Max has 4").replace("Tom gives", "Ben gives").replace("Tom goes", "Max goes")
    texts = [
        (1, f"Some words first. {QUESTION}. And more after."),
        (2, f"Some words first. {changed}. And more after."),
        (3, "Nothing of the kind is in here, only a plain story about apples and neighbours."),
        (4, mixed),
        (5, None), (6, ""), (None, QUESTION), (7, QUESTION), (7, QUESTION),
        (8, swapped.replace("Tom", "Eve").replace("12", "40")),
    ]
    docs, bench = leaks(spark, texts, [(70, QUESTION), (71, swapped), (72, None), (73, ""), (None, "far too short")])
    found = decontaminate.contaminated(docs, bench)
    same(tuples(found, "doc_id", "item_id"), [(1, 70), (2, 70), (None, 70), (7, 70), (8, 71)])
    changes = {r["doc_id"]: r["n_changed"] for r in found.collect()}
    assert changes[1] == 0 and changes[2] > 0
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    same([r["doc_id"] for r in clean.collect()], [3, 4, 5, 6])


def test_op4_finds_literal_copies_in_any_case_and_of_short_items(spark):
    german = "Die Straße hinter dem Fluß führt zu Anna und Otto in das alte Haus am Markt"
    items = [(1, QUESTION), (2, german), (3, "What is 12 + 7 * 3 - 5?"), (4, "Who wrote Hamlet?"), (5, "12 + 7 * 3 - 5 + 9 * 8 - 4 / 2 is how much"), (6, "Fluß und Straße")]
    copies = [(10 * i + k, f"and so: {f(t)} ... ok") for i, t in items for k, f in enumerate([str, str.lower, str.upper, str.title])]
    others = [(60, "What is 13 + 7 * 3 - 5?"), (61, "who ever wrote hamlet"), (62, "12 + 7 * 3 - 5 + 9")]
    docs, bench = leaks(spark, copies + others, items)
    found = decontaminate.contaminated(docs, bench)
    same(tuples(found, "doc_id", "item_id", "n_changed"), [(i, i // 10, 0) for i, _ in copies])


SHIFTED = "yesterday Tom from Paris took 3 apples home and then Tom sold 3 pears for 2 km to Paris"
PRICED = "a boy buys 2 apples for 2 dollars and sells 7 of the pears he got for 9 dollars to a friend of his"


def test_op4_finds_values_of_other_lengths_and_numbers_that_coincide(spark):
    longer = SHIFTED.replace("Tom", "Mary Ann").replace("Paris", "New York")
    items = [(1, SHIFTED), (2, PRICED)]
    texts = [
        (10, f"once more: {longer}, or so"),
        (11, longer.replace("2 km", "5")),
        (12, "yesterday Sue Lee from New York took 3 apples home and then Mary Ann sold 3 pears"),  # two people where the item has one
        (13, SHIFTED.replace("3 apples", "4 kg apples")),
        (20, PRICED.replace("2 apples for 2", "3 apples for 5").replace("7", "8").replace("9", "4")),
        (21, PRICED.replace("2", "6").replace("7", "4").replace("9", "4")),
        (22, "a boy buys nothing and a friend of his sells all the pears he got"),
    ]
    docs, bench = leaks(spark, texts, items)
    found = decontaminate.contaminated(docs, bench)
    same(tuples(found, "doc_id", "item_id"), [(10, 1), (11, 1), (13, 1), (20, 2), (21, 2)])
    assert {r["doc_id"]: r["start"] for r in found.collect()}[10] == 2


def test_op4_template_and_raw_tokens_run_in_step(spark):
    texts = [QUESTION, "a1b 2.5kg B2Boy İstanbul ISTANBUL İSTANBUL ½ x", "...", "", "5 km 3  hours10 min Zoë's", "ﬁne STRAẞE ǅ ñandú"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in frame.select(decontaminate.template(F.col("text")).alias("a"), decontaminate.raw_tokens(F.col("text")).alias("b")).collect():
        assert len(r["a"]) == len(r["b"])


def test_op4_short_items_empty_tables_and_shuffle_join(spark, monkeypatch):
    docs, bench = leaks(spark, [(1, "we met blue owls near tall trees today"), (2, "other text of no importance whatsoever to anyone")], [(1, "blue owls near tall trees")])
    same(tuples(decontaminate.contaminated(docs, bench), "doc_id", "item_id"), [(1, 1)])
    monkeypatch.setattr(decontaminate, "BROADCAST_HASHES", 0)
    same(tuples(decontaminate.contaminated(docs, bench), "doc_id", "item_id"), [(1, 1)])
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0


@needs_tables
def test_op4_finds_the_literal_passages(spark):
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    grams = {g for t in items for g in plain.shingle_set(t, 8)}
    expected = {i for i, t in pairs(documents(spark)) if len(plain.shingle_set(t, 8) & grams) >= 3}
    assert {r["doc_id"] for r in queries.op4_decontaminate(spark, DATA).collect()} == expected


def test_op4_runs_no_python(spark):
    docs, bench = leaks(spark, [(1, QUESTION)], [(1, QUESTION)])
    plan = decontaminate.contaminated(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# 5 and 9: classifiers


def labelled(spark, rows, name):
    docs = spark.createDataFrame([(i, t, *plain.FILL) for i, t, _ in rows], plain.DOCUMENTS)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], f"doc_id long, {name} int, text string")
    return docs, labels


def test_op5_learns_and_bears_odd_rows(spark, odd):
    random = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(200)]

    def text(bad):
        chosen = [str(x) for x in random.choice(vocabulary, size=30)]
        return " ".join(x + "$$$" for x in chosen) if bad else " ".join(chosen)

    docs, labels = labelled(spark, [(i, text(i % 4 == 0), int(i % 4 != 0)) for i in range(300)], "quality")
    held = fold("doc_id", 5)
    found = {r["doc_id"]: r for r in quality.score(docs, labels, held != 0).collect()}
    wrong = [i for i in found if plain.fold(i, 5) == 0 and found[i]["predicted"] != int(i % 4 != 0)]
    assert len(found) == 300 and not wrong
    # the same model on rows with nulls, empty and long texts
    scored = quality.score(docs.union(odd), labels, held != 0).collect()
    assert len(scored) == 300 + odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score(odd.limit(0), labels, held != 0).count() == 0
    one_class = quality.score(odd, labels.filter("quality = 1").limit(0), held != 0)
    assert {r["score"] for r in one_class.collect()} == {0.5}


def test_op9_learns_terms_and_bears_odd_rows(spark, odd):
    random = np.random.default_rng(2)
    vocabulary = [f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]

    def text(toxic):
        chosen = [str(x) for x in random.choice(vocabulary, size=40)]
        if toxic:
            chosen[10], chosen[25] = "blorghead", "zwackel" + str(random.choice(["ung", "heit", "isch", "lich"]))
        return " ".join(chosen)

    docs, labels = labelled(spark, [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(400)], "toxic")
    learn = fold("doc_id", 3) != 1
    found = {r["doc_id"]: r for r in toxicity.score(docs, labels, learn).collect()}
    wrong = [i for i in found if plain.fold(i, 3) == 1 and found[i]["predicted"] != int(i % 5 == 0)]
    assert len(found) == 400 and not wrong
    scored = toxicity.score(docs.union(odd), labels, learn).collect()
    assert len(scored) == 400 + odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in scored)
    assert toxicity.score(odd.limit(0), labels, learn).count() == 0
    assert {r["predicted"] for r in toxicity.score(odd, labels.limit(0), learn).collect()} == {0}
    kept = toxicity.acceptable(docs, labels, learn)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in found.values())


def test_op9_grammar_tells_clause_kinds_apart():
    grammar = toxicity.Grammar({"idiot": 1.0}, {"moron": 2.0})
    names = [n for n, _ in toxicity.FEATURES]

    def matched(text):
        return {n for n, v in zip(names, grammar.features(text), strict=True) if v}

    assert matched("you are an idiot") == {"matched", "insult", "targeted"}
    assert matched("he is not an idiot.") == {"matched", "insult_negated"}
    assert matched("not now, idiot") == {"matched", "insult"}  # a negation ends with its clause
    assert matched("she said you were an idiot") == {"matched", "insult", "targeted", "reported"}
    assert matched("I will kill you") == {"matched", "threat", "targeted"}
    assert matched("what moronic talk") == {"matched", "insult"}  # by its stem
    assert matched("a nice day") == set() == matched(None) == matched("")


# 6: sharding


def leaf_check(rows, limit):
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
    for r in rows:
        assert size[r["shard"]] == r["shard_bytes"] and r["oversize"] == (r["shard_bytes"] > limit)
    shards = sorted(size)
    # prefixes are never prefixes of each other, and no two siblings would fit together
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:], strict=False))
    for a in shards:
        sibling = a[:-1] + ("1" if a.endswith("0") else "0") if a else None
        if sibling in size:
            assert size[a] + size[sibling] > limit or a == ""


@needs_tables
@pytest.mark.parametrize("limit,step", [(10**9, 12), (60_000, 12), (60_000, 2), (3_000, 3)])
def test_op6_shards_fit(spark, monkeypatch, limit, step):
    monkeypatch.setattr(sharding, "STEP_BITS", step)
    rows = sharding.assign(documents(spark), limit).collect()
    same([r["doc_id"] for r in rows], [i for i, _ in pairs(documents(spark))])
    leaf_check(rows, limit)
    for r in rows:
        assert not r["oversize"] or r["shard_rows"] == 1


def test_op6_odd_rows(odd, nothing, tmp_path):
    rows = sharding.assign(odd, 500).collect()
    same([(r["doc_id"], r["n_bytes"]) for r in rows], [(i, len((t or "").encode())) for i, t, *_ in plain.odd_rows()])
    leaf_check(rows, 500)
    assert sharding.assign(nothing, 500).count() == 0
    sharding.write_shards(odd, str(tmp_path / "shards"), 500)
    back = odd.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert back.columns == [*odd.columns, "shard"]
    same([(r["doc_id"], r["text"]) for r in back.collect()], [(i, t) for i, t, *_ in plain.odd_rows()])


# 7: packing


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_op7_buckets_are_optimal(buckets):
    random = np.random.default_rng(4)
    for _ in range(40):
        lengths = random.integers(0, 30, size=int(random.integers(1, 25))).tolist()
        limits = packing.bucket_limits(list(Counter(lengths).items()), buckets)
        assert limits == sorted(set(limits)) and len(limits) <= buckets and limits[-1] == max(lengths)
        padding = sum(min(x for x in limits if x >= v) - v for v in lengths)
        assert padding == plain.least_padding(lengths, buckets)


def batch_check(rows, expected, context, budget):
    total = Counter()
    for r in rows:
        assert 0 <= r["n_tokens"] <= min(context, r["bucket_len"]) and r["padding"] == r["bucket_len"] - r["n_tokens"]
        total[r["doc_id"]] += r["n_tokens"]
    assert {i: n for i, n in total.items()} == expected
    batches, limits = Counter((r["bucket"], r["batch"]) for r in rows), {r["bucket"]: r["bucket_len"] for r in rows}
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in rows}) == len(rows)
    for bucket, length in limits.items():
        own = sorted(b for k, b in batches if k == bucket)
        assert own == list(range(len(own)))
        capacity = max(1, budget // max(1, length))
        assert all(batches[bucket, b] == capacity for b in own[:-1])


@needs_tables
@pytest.mark.parametrize("slot", [packing.SLOT_ROWS, 7])
def test_op7_packs_everything(spark, monkeypatch, slot):
    monkeypatch.setattr(packing, "SLOT_ROWS", slot)
    rows = packing.pack(documents(spark), 256, 4, 2048).collect()
    batch_check(rows, {i: len(plain.words(t)) for i, t in pairs(documents(spark))}, 256, 2048)


def test_op7_odd_rows(odd, nothing):
    rows = packing.pack(odd, 64, 3, 100).collect()
    expected = Counter()
    for i, t, *_ in plain.odd_rows():
        expected[i] += len(plain.words(t))
    batch_check(rows, dict(expected), 64, 100)
    assert packing.pack(nothing).count() == 0


# 8: line deduplication

LINE = ("doc_id", "n_lines", "n_removed", "n_runs", "kept")


@needs_tables
@pytest.mark.parametrize("min_words", [1, 10, 40])
def test_op8_matches_plain(spark, min_words):
    same(tuples(line_dedup.deduplicate(documents(spark), min_words), *LINE), plain.line_rows(sorted(pairs(documents(spark))), min_words))


def test_op8_runs_of_many_lines(spark):
    random = np.random.default_rng(6)
    pool = ["", "a", "b c", "d e f", "g"]
    rows = [(i, "\n".join(str(x) for x in random.choice(pool, size=25))) for i in range(25)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for min_words in (3, 8, 15):
        same(tuples(line_dedup.deduplicate(frame, min_words), *LINE), plain.line_rows(rows, min_words))


def test_op8_odd_rows(odd, nothing):
    by_id = sorted(((i, t) for i, t, *_ in plain.odd_rows()), key=lambda r: (r[0] is None, r[0] or 0, r[1] is None))
    same(tuples(line_dedup.deduplicate(odd), *LINE), plain.line_rows(by_id, line_dedup.MIN_WORDS))
    kept = line_dedup.cleaned(odd)
    assert kept.columns == odd.columns
    gone = Counter(i for i, *_ in plain.odd_rows()) - Counter(r["doc_id"] for r in kept.collect())
    assert gone == Counter([2, 2, None, 11, 11])
    assert line_dedup.deduplicate(nothing).count() == 0 and line_dedup.cleaned(nothing).count() == 0


# 10: language model

BASE = ("doc_id", "n_tokens", "n_known", "train_tokens")


def base_check(rows, texts, learn):
    expected = plain.unigram_rows(texts, learn)
    same([tuple(r[n] for n in BASE) for r in rows], [e[:4] for e in expected])
    assert sorted(round(r["base_score"], 6) for r in rows) == pytest.approx(sorted(e[4] for e in expected), abs=1e-5)


@needs_tables
@pytest.mark.parametrize("known", [hmm.KNOWN, 5000])
def test_op10_counts_and_base(spark, monkeypatch, known):
    monkeypatch.setattr(hmm, "KNOWN", known)
    rows = queries.op10_hmm(spark, DATA).collect()
    base_check(rows, pairs(documents(spark)), lambda i: plain.fold(i, 10) != 0)
    held = [r for r in rows if r["held_out"]]
    assert held and all(plain.fold(r["doc_id"], 10) == 0 for r in held)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op10_odd_rows(odd, nothing):
    rows = hmm.score(odd, fold("doc_id", 10) == 0, rounds=1).collect()
    base_check(rows, [(i, t) for i, t, *_ in plain.odd_rows()], lambda i: plain.fold(i, 10) != 0)
    assert hmm.score(nothing, fold("doc_id", 10) == 0).count() == 0
    unseen = hmm.score(odd, F.lit(True), rounds=1).collect()
    assert len(unseen) == odd.count() and {r["n_known"] for r in unseen} == {0}


def test_op10_forward_and_counts_match_plain():
    random = np.random.default_rng(8)
    p = hmm.first_guess(random.integers(0, 50, size=hmm.WIDTH).astype(float))
    p = hmm.Parameters(random.dirichlet(np.ones(hmm.STATES)), random.dirichlet(np.ones(hmm.STATES), size=hmm.STATES), p.emit)
    sequences = [np.append(random.integers(0, 200, size=n), hmm.END) for n in (0, 1, 7, 30, 300, 520)]
    expected_log, total = [], np.zeros(hmm.STATES + hmm.STATES**2 + hmm.WIDTH * hmm.STATES)
    for s in sequences:
        alpha = [p.start * p.emit[s[0]]]
        for x in s[1:]:
            alpha.append(alpha[-1] / alpha[-1].sum() @ p.move * p.emit[x])
        expected_log.append(sum(np.log10(a.sum()) for a in alpha))
        if len(s) <= hmm.SEGMENT:
            scaled = [a / a.sum() for a in alpha]
            beta = np.ones(hmm.STATES)
            starts, moves, emits = np.zeros(hmm.STATES), np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.WIDTH, hmm.STATES))
            for t in range(len(s) - 1, -1, -1):
                gamma = scaled[t] * beta / (scaled[t] * beta).sum()
                emits[s[t]] += gamma
                if t:
                    joint = scaled[t - 1][:, None] * p.move * (p.emit[s[t]] * beta)[None]
                    moves += joint / joint.sum()
                    beta = p.move @ (p.emit[s[t]] * beta)
                    beta /= beta.sum()
                else:
                    starts += gamma
            total += np.concatenate([starts, moves.ravel(), emits.ravel()])
    assert hmm.forward_log10(sequences, p) == pytest.approx(expected_log)
    short = [s for s in sequences if len(s) <= hmm.SEGMENT]
    assert hmm.expected_counts(short, p) == pytest.approx(total, abs=1e-9)
    long_counts = hmm.expected_counts(sequences, p)
    assert long_counts[hmm.STATES + hmm.STATES**2 :].sum() == pytest.approx(sum(len(s) for s in sequences))


def test_op10_training_raises_the_likelihood(odd):
    """More rounds of Baum-Welch never make the training texts less likely."""
    totals = [sum(r["score"] for r in hmm.score(odd, F.lit(False), rounds=n).collect()) for n in (0, 2, 5)]
    assert totals[0] < totals[1] <= totals[2] + 1e-6 * abs(totals[2])


# names that clash

CLASH = "doc_id long, text string, TEXT string, Doc_Id string, `a.b` int, shard string, k1 string, l1 string"


def clashing(spark):
    rows = [(i, t, "other", "id", 3, "s", "k", "l") for i, t in ((1, plain.BODY), (2, "you stupid idiot, shut up"), (3, None), (4, ""))]
    return spark.createDataFrame(rows, CLASH)


def test_stages_bear_names_that_differ_in_case(spark):
    frame = clashing(spark)
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(1, plain.BODY, "x")], "item_id long, text string, TEXT string")
    for found in (
        decontaminate.clean_documents(frame, benchmark),
        toxicity.acceptable(frame, labels, F.lit(True)),
        near_dedup.deduplicated(frame),
        line_dedup.cleaned(frame),
    ):
        assert found.columns == frame.columns
        assert {tuple(r) for r in found.collect()} <= {tuple(r) for r in frame.collect()}
    assert {r[0] for r in decontaminate.clean_documents(frame, benchmark).collect()} == {2, 3, 4}


def test_op6_write_shards_beside_a_column_of_that_name(spark, tmp_path):
    frame = clashing(spark).toDF("doc_id", "text", "text_2", "id_2", "a.b", "Shard", "k1", "l1")
    sharding.write_shards(frame, str(tmp_path / "out"), 60)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == [*frame.columns, "shard_"]
    same([tuple(r)[:-1] for r in back.collect()], [tuple(r) for r in frame.collect()])


def test_op3_equal_vectors_emit_no_more_than_k_a_block(spark, monkeypatch):
    rows = [(i, [0.5, 0.25]) for i in range(400)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, k=5)
    for r in found.collect():
        expected = [i for i in range(7) if i != r["query_id"]][r["rank"] - 1]
        assert r["vec_id"] == expected
    import pandas as pd

    vectors = pd.DataFrame({"row": range(400), "vec_id": range(400), "v": [[1, 2]] * 400})
    queries_ = pd.DataFrame({"row": range(0, 400, 50), "vec_id": range(0, 400, 50), "v": [[1, 2]] * 8, "cutoff": [5] * 8})
    assert len(topk._last_phases(5, 8)(vectors, queries_)) == 8 * 5


def test_op3_rows_of_one_id_are_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 1.0]), (7, [1.0, 0.0]), (7, [0.5, 0.0]), (7, [0.5, 0.0]), (9, [0.0, 1.0])]
    expected = []
    for a, (query, q) in enumerate(rows):
        if query == 0:
            scores = sorted((-sum(int(256 * x) * int(256 * y) for x, y in zip(q, v, strict=True)), i) for b, (i, v) in enumerate(rows) if b != a)
            expected += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:4], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    same(tuples(topk.top_k(frame, F.col("vec_id") == 0, 4), "query_id", "rank", "vec_id", "score"), expected)


def test_op6_one_hash_is_never_split_and_ids_count(spark):
    rows = [(1, "x" * 50)] * 3 + [(2, "x" * 50), (None, "x" * 50), (None, None), (3, "")]
    found = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 60).collect()
    leaf_check(found, 60)
    same([(r["doc_id"], r["shard_rows"]) for r in found if r["oversize"]], [(1, 3)] * 3)


@needs_tables
@pytest.mark.parametrize("limit", [queries.SHARD_BYTES, 16 * 1024])
def test_op6_matches_sql(spark, monkeypatch, limit):
    sql = queries.EXPECTED["op6_sharding"].replace(str(queries.SHARD_BYTES), str(limit))
    monkeypatch.setattr(queries, "SHARD_BYTES", limit)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    columns = ("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows", "oversize")
    rows = tuples(queries.op6_sharding(spark, DATA), *columns)
    same(rows, connection.execute(sql).fetchall())
    assert len({r[2] for r in rows}) > 1 or sum(r[1] for r in rows) <= limit


NAMES = "Otto Berta Carl Dora Emil Frieda Gustav Hanna Ida Jonas Karla Ludwig Mina Norbert Olga Paula".split()


def reworded(text, random):
    """The text with other numbers, and with other names, each for the same name throughout."""
    text = re.sub(r"\d+", lambda m: str(random.integers(2, 9000)), text)
    chosen = iter(random.permutation(NAMES).tolist())
    stand_in = {}
    return re.sub(r"\b[A-Z][a-z]+\b", lambda m: stand_in.setdefault(m[0], next(chosen, m[0])), text)


@needs_tables
def test_op4_recall_of_reworded_items(spark):
    random = np.random.default_rng(5)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    made = [
        (1000 + i, f"{a} had {n} boxes of {what} on the shelf and gave {m} of them to {b} before the market closed at {n + m} in the evening")
        for i, (a, b, n, m, what) in enumerate(
            (*random.choice(NAMES, size=2, replace=False), int(random.integers(2, 90)), int(random.integers(2, 90)), w) for w in "pears nails books stamps tea wool".split()
        )
    ]
    texts = [(i, f"as was said before: {reworded(t, random)} and so on") for i, t in items + made]
    docs, bench = leaks(spark, texts, items + made)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    recall = sum((i, i) in found for i, _ in texts) / len(texts)
    assert recall >= 0.9, recall
