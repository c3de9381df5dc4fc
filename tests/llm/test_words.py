"""Spelling variants, periodic runs and pieces against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import groupby
from pathlib import Path

import pytest

from fiscora.llm import periodic_runs, pieces, queries, spelling

from . import plain

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

DATA = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(DATA).is_dir(), reason="test tables are not here")
CLASH = "doc_id long, text string, TEXT string, Doc_Id string, `a.b` int, word string, n string, key string, runs string, ids string"
FILL = ("another", "id", 1, "w", "n", "k", "r", "i")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *FILL) for r in rows], CLASH)


def table(spark, sf_dir=DATA):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def odd():
    return [(i, t) for i, t, *_ in plain.odd_rows()]


# 11: spelling variants


def letters(text):
    run = ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c.lower() if c <= "z" else c
        elif run:
            yield run
            run = ""


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_rows(rows, noise, chars=6, seen=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in letters(text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise is not None and h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= chars and c >= seen}
    near = defaultdict(list)
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    for w in n:
        near[w] = [v for d in (-1, 0, 1) for v in by_length[len(w) + d] if one_edit(w, v)]
    best = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: v if v is not None and n[v] >= 5 * n[w] else None for w, v in best.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return Counter((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def spelling_found(found):
    return Counter((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found.collect())


@needs_tables
def test_op11_matches_plain(spark):
    expected = spelling_rows(table(spark), 199)
    assert any(row[1] for row in expected)
    assert spelling_found(queries.op11_spelling(spark, DATA)) == expected


def chain(noise=None):
    """Variants of variants, ties, near words that differ at every place."""
    words = ["planets"] * 5 + ["planet"] * 30 + ["planed"] * 200 + ["plaaned"] * 200 + ["xplaned"] * 7 + ["planex"] * 6
    words += ["ÀÉÎõü×"] * 5 + ["ÀÉÎõü÷"] * 25 + ["short"] * 50 + ["rarely"] * 4
    rng = random.Random(4)
    words += [w for w in {"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(60)} for _ in range(rng.randint(5, 90))]
    rng.shuffle(words)
    return [(i, " ".join(words[i::7]) + ".") for i in range(7)]


@pytest.mark.parametrize(("symbols", "lookups", "rows"), [(60, 5, 40), (150, 1 << 12, 1 << 16)])
def test_op11_blocks_and_chains(spark, monkeypatch, symbols, lookups, rows):
    """Halves that many words share are dealt to several blocks."""
    monkeypatch.setattr(spelling, "BLOCK_SYMBOLS", symbols)
    monkeypatch.setattr(spelling, "LOOKUPS", lookups)
    monkeypatch.setattr(spelling, "TABLE_ROWS", rows)
    monkeypatch.setattr(spelling, "TASK_ROWS", 200)
    for noise in (None, 3):
        assert spelling_found(spelling.group(frame(spark, chain()), noise)) == spelling_rows(chain(), noise)


def test_op11_very_long_words(spark):
    rows = [(1, ("l" + "o" * 3000 + "ng ") * 5), (2, ("L" + "o" * 3001 + "ng ") * 25), (3, "x" * 6000 + "\n" + "x" * 6001)]
    assert spelling_found(spelling.group(frame(spark, rows), 7, least_seen=1)) == spelling_rows(rows, 7, seen=1)


@pytest.mark.parametrize("chars", [2, 5])
def test_op11_odd_rows(spark, chars):
    rows = odd() * 3
    found = spelling.group(frame(spark, rows), 5, least_chars=chars, least_seen=2)
    assert spelling_found(found) == spelling_rows(rows, 5, chars, 2)
    assert spelling.group(frame(spark, [])).count() == 0


@pytest.mark.parametrize("rows", [1 << 16, 13])
def test_op11_index_finds_every_near_word(monkeypatch, rows):
    monkeypatch.setattr(spelling, "TABLE_ROWS", rows)
    rng = random.Random(rows)
    for _ in range(30):
        words = sorted({"".join(rng.choice("abéÿ") for _ in range(rng.randint(2, 8))) for _ in range(90)})
        index, found = spelling.Index(words), set()
        for half in (spelling.LEFT, spelling.RIGHT):
            some, near = index.near([*words, "unknown"], half)
            found |= {(words[a], words[b]) for a, b in zip(some.tolist(), near.tolist(), strict=True)}
        assert found == {(a, b) for a in words for b in words if a != b and one_edit(a, b)}


# 12: periodic runs


def runs_of(words):
    found = []
    for period in range(1, len(words) // 4 + 1):
        at = 0
        for agrees, stretch in groupby(a == b for a, b in zip(words, words[period:], strict=False)):
            n = len(list(stretch))
            if agrees and n + period >= max(6, 4 * period):
                part = words[at : at + n + period]
                if next(q for q in range(1, period + 1) if part[q:] == part[: len(part) - q]) == period:
                    found.append((at, len(part), period))
            at += n
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_rows(rows, wrap):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        how = wrap(doc_id, len(words))
        if how:
            a, p = how
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = runs_of(words)
        gone = {i for s, n, p in found for i in range(s + p, s + n)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        digests = (hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
        out.append((doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, *digests))
    return Counter(out)


PERIODIC = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def periodic_found(found):
    return Counter(tuple(r[n] for n in PERIODIC) for r in found.collect())


def contract_wrap(doc_id, n):
    """The rewriting as the contract words it."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 != 0 or n == 0:
        return None
    g = h // 10
    return g % n, 1 + (n - g % n) // (3 + g % 8)


@needs_tables
def test_op12_matches_plain(spark):
    rows = [r for r in table(spark) if len((r[1] or "").split()) < 400]
    frame_ = spark.createDataFrame(rows, "doc_id long, text string")
    found = periodic_runs.find_runs(frame_, queries.wrapped)
    expected = periodic_rows(rows, contract_wrap)
    assert sum(r[1] > 0 for r in expected) > 5
    assert periodic_found(found) == expected
    assert queries.op12_periodic_runs(spark, DATA).count() == len(table(spark))


def test_op12_odd_and_periodic_rows(spark):
    rng = random.Random(1)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 250:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts = [fibonacci[-1], "a" * 6, "a" * 5, "ab" * 4, "ab" * 3 + "a", "abc" * 40 + "abd" * 40, ("aaab" * 9 + "c") * 5, "x" * 400]
    for _ in range(60):
        letters_ = "abcdefgh"[: rng.randint(1, 8)]
        part = "".join(rng.choice(letters_) for _ in range(rng.randint(1, 15)))
        texts.append((part * rng.randint(1, 9))[rng.randint(0, 5) :] + "".join(rng.choice(letters_) for _ in range(rng.randint(0, 40))))
    rows = [r for r in odd() if r[0] not in (12, 13)] + [(100 + i, " \t".join(t)) for i, t in enumerate(texts)]

    def none(doc_id, n):
        return None

    for wrap in (none, queries.wrapped):
        found = periodic_runs.find_runs(frame(spark, rows), wrap, keep=True)
        assert periodic_found(found) == periodic_rows(rows, wrap)
    for r in found.collect():
        assert hashlib.sha256(r["collapsed"].encode()).hexdigest() == r["collapsed_sha256"]
        assert len(r["runs"]) == r["n_runs"]
    assert periodic_runs.find_runs(frame(spark, [])).count() == 0


def test_op12_very_long_text(spark):
    """A period of thousands of words, and copies in other texts, which are no runs."""
    part = " ".join(f"w{i * 7919 % 10007}" for i in range(5000))
    rows = [(1, " ".join([part] * 4)), (2, part), (3, part), (4, " ".join([part] * 3))]
    found = {r["doc_id"]: r for r in periodic_runs.find_runs(frame(spark, rows), keep=True).collect()}
    assert [tuple(x) for x in found[1]["runs"]] == [(0, 20000, 5000)] and found[1]["collapsed"] == part
    assert all(found[i]["n_runs"] == 0 for i in (2, 3, 4))


# 13: pieces


@pytest.fixture(scope="module")
def model():
    return tokenizers.path(queries.PIECE_MODEL)


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_file=model)


@pytest.fixture(scope="module")
def encoder(model):
    return pieces.Encoder(pieces.Vocabulary.load(model))


def piece_rows(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        digests = (",".join(map(str, ids)), library.decode(ids))
        out.append((doc_id, len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    return Counter(out)


def piece_found(found):
    return Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found.collect())


@needs_tables
def test_op13_equals_the_library(spark, library):
    assert piece_found(queries.op13_pieces(spark, DATA)) == piece_rows(table(spark), library)


def test_op13_odd_rows(spark, model, library):
    texts = ["   two  spaces ", "▁ sign", "tab\tline\r\n\n", "　wide 😀 ｱ \x00 �", "<s> </s> <0x0A> <unk>", "x" * 5000, "no" * 4000 + "!", "word,\"word\".) a,b"]
    rows = odd() + [(200 + i, t) for i, t in enumerate(texts)]
    vocabulary = pieces.Vocabulary.load(model)
    found = pieces.encode(frame(spark, rows), vocabulary, keep=True)
    assert piece_found(found) == piece_rows(rows, library)
    expected = Counter((i, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in found.collect()) == expected
    assert pieces.encode(frame(spark, []), vocabulary).count() == 0


@pytest.mark.parametrize("kept", [pieces.KEPT_PAIRS, 3])
def test_op13_random_texts(monkeypatch, model, library, kept):
    monkeypatch.setattr(pieces, "KEPT_PAIRS", kept)
    encoder = pieces.Encoder(pieces.Vocabulary.load(model))
    rng = random.Random(2)
    parts = [*" ▁\n\r\tabcdeABé😀ｱ<0x>1.", "   ", "the", "tion", "你", "ing ", "aaaa", "....", "=====", ", ", '."']
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = library.encode(text)
        assert encoder.encode(text) == ids and encoder.decode(ids) == library.decode(ids), text


def test_op13_decodes_any_ids(encoder, library):
    rng = random.Random(3)
    for _ in range(500):
        ids = [rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31_999)]) for _ in range(rng.randint(0, 7))]
        assert encoder.decode(ids) == library.decode(ids), ids


def test_op13_backtracks(encoder, library):
    """Words whose longest pieces in a row do not stay apart."""
    stuck = 0
    for word in ("undesirable", "unhappily", "thethethe", "internationalizations", "aaaaaaaaaaaaab", "weirdestthing"):
        greedy = [piece for _, piece in encoder.automaton.iter_long("▁" + word)]
        found = encoder.encode(word)
        stuck += greedy != found
        assert found == library.encode(word)
    assert stuck
