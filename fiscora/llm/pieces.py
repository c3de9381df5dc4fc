"""Encoding into merge-built pieces (byte-pair encoding as SentencePiece does it), and decoding.

Merging joins the neighbours whose union scores best, the leftmost first, until no union is a piece.
What it ends with can be found from left to right instead: a sequence of pieces is the merged one
exactly if every two neighbours stay apart when their joined text is merged anew. So the longest
piece (found by an Aho-Corasick automaton) is tried first, then the shorter ones; a place from which nothing fits is marked in a bitfield and never tried again, as
the pieces before a place are always the same.

Text is cut before spaces, since no piece holds a space after another character, and before the mark
that ends a word if the pieces beside the cut stay apart. Words recur, so each Python worker keeps the
latest ones with their pieces. Documents do not meet: there is no shuffle.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby, pairwise

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame

from fiscora.llm.common import narrow

SPACE = "▁"  # stands for a space inside pieces
UNKNOWN_TEXT = " ⁇ "  # what the unknown id decodes to
KEPT_WORDS, KEPT_PAIRS = 1 << 19, 1 << 19  # words, and pairs of pieces, that a Python worker remembers
NEVER = float("-inf")
KEPT_CHARS = 48  # longer words are rarely met again
MARKS = ".,;:!?)\"'"  # what often follows a word

Encoded = tuple[int, str, str, int, int]  # of a word: number of ids, ids as text, decoded, first and last id


@dataclass(frozen=True)
class Vocabulary:
    """A model's pieces: its size alone bounds what is sent to the executors."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    mergeable: tuple[bool, ...]  # neither a byte nor a control or unknown id
    byte_ids: tuple[int, ...]  # id of each byte value
    unknown: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file. It must be of the merge type, with byte fallback and without text normalisation."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        bytes_ = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
        if len(bytes_) != 256:
            raise ValueError("the model has no byte fallback")
        if model.normalize(" a  ﬁ\r\n ") != f"{SPACE * 2}a{SPACE * 2}ﬁ\r\n{SPACE}":
            raise ValueError("the model changes its input before encoding")
        plain = tuple(not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in ids)
        pieces = tuple(model.id_to_piece(i) for i in ids)
        if any(SPACE in p.lstrip(SPACE) for p, usable in zip(pieces, plain, strict=True) if usable):
            raise ValueError("a piece holds a space after another character")
        return cls(pieces, tuple(model.get_score(i) for i in ids), plain, tuple(bytes_[f"<0x{b:02X}>"] for b in range(256)), model.unk_id())


def _each_bad_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("each_bad_byte", _each_bad_byte)


class Encoder:
    """Pieces of words, and back."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.ids = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.mergeable[i]}
        self.scores = {p: vocabulary.scores[i] for p, i in self.ids.items()}
        self.known = set("".join(self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in vocabulary.pieces]
        self.widest = max(map(len, self.ids))
        self.shorter = [self._shorter(p) if usable else -1 for p, usable in zip(vocabulary.pieces, vocabulary.mergeable, strict=True)]
        self.decimal = [str(i) for i in range(len(vocabulary.pieces))]
        # a line feed that is no part of a piece cuts words too
        cut = SPACE if "\n" in self.known else f"{SPACE}\n"
        self.find_words: Callable[[str], list[str]] = re.compile(f"{SPACE}+[^{cut}]*|[^{cut}]+|\n").findall
        self.shown = [p if usable else "" for p, usable in zip(vocabulary.pieces, vocabulary.mergeable, strict=True)]
        self.shown[vocabulary.unknown] = UNKNOWN_TEXT
        self.byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        self.pairs: dict[int, bool] = {}
        self.core = lru_cache(maxsize=KEPT_WORDS)(self._core)
        self.word = lru_cache(maxsize=KEPT_WORDS)(self._word)

    def _shorter(self, piece: str) -> int:
        """The longest other piece that this one begins with, or -1."""
        return next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), -1)

    def merged(self, text: str, seam: int = 0) -> list[str] | None:
        """Merging as defined, for short texts; None as soon as a union crosses the ``seam``."""
        parts, score = list(text), self.scores.get
        unions = [score(a + b, NEVER) for a, b in pairwise(parts)]
        while unions:
            best = max(unions)
            if best == NEVER:
                break
            at = unions.index(best)
            if at + 1 == seam:
                return None
            if at + 1 < seam:
                seam -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del unions[at]
            if at < len(unions):
                unions[at] = score(parts[at] + parts[at + 1], NEVER)
            if at:
                unions[at - 1] = score(parts[at - 1] + parts[at], NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Do two pieces stay as they are beside each other? ``left`` -1: does the piece come about at all?"""
        key = (left << 32) | right
        if key not in self.pairs:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            pieces = self.vocabulary.pieces
            if left < 0:
                self.pairs[key] = self.merged(pieces[right]) == [pieces[right]]
            else:
                self.pairs[key] = self.merged(pieces[left] + pieces[right], len(pieces[left])) == [pieces[left], pieces[right]]
        return self.pairs[key]

    def _longest(self, text: str, at: int) -> int:
        """The longest piece that begins at a place."""
        return next(self.automaton.iter_long(text[at : at + self.widest]))[1]

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        size, lengths, shorter, pairs = len(text), self.lengths, self.shorter, self.pairs
        # the longest pieces in a row are where most words go along
        ahead = {end + 1 - lengths[piece]: piece for end, piece in self.automaton.iter_long(text)}
        failed, any_failed = bytearray(size // 8 + 1), False
        chosen: list[int] = []
        at, last, piece = 0, -1, ahead[0]
        while True:
            while piece >= 0:
                end = at + lengths[piece]
                if not (any_failed and failed[end >> 3] & (1 << (end & 7))):
                    fits = pairs.get((last << 32) | piece)
                    if fits or (fits is None and self.compatible(last, piece)):
                        break
                piece = shorter[piece]
            if piece >= 0:
                chosen.append(piece)
                if end == size:
                    return chosen
                at, last = end, piece
                piece = ahead[at] if at in ahead else self._longest(text, at)
            else:
                any_failed = True
                failed[at >> 3] |= 1 << (at & 7)
                longer = chosen.pop()
                at, last, piece = at - lengths[longer], chosen[-1] if chosen else -1, shorter[longer]

    def _core(self, word: str) -> Encoded:
        if self.known.issuperset(word):
            ids = self.backtrack(word)
            decoded = "".join([self.shown[i] for i in ids])
        else:
            # a character that is no piece is part of none: it ends what can be merged
            ids = []
            for known, run in groupby(word, self.known.__contains__):
                part = "".join(run)
                ids += self.backtrack(part) if known else [self.vocabulary.byte_ids[b] for b in part.encode("utf-8", "replace")]
            decoded = self.joined(ids)
        return len(ids), ",".join([self.decimal[i] for i in ids]), decoded, ids[0], ids[-1]

    def _word(self, word: str) -> Encoded:
        """A word, encoded and decoded, with ``SPACE`` as it is."""
        body = word.rstrip(MARKS)
        if len(word) > KEPT_CHARS:
            return self._core(word)
        if len(body) in (0, len(word)):
            return self.core(word)
        first, second = self.core(body), self.core(word[len(body) :])
        if self._apart(first[4], second[3]):
            return first[0] + second[0], f"{first[1]},{second[1]}", first[2] + second[2], first[3], second[4]
        return self._core(word)

    def _apart(self, left: int, right: int) -> bool:
        """Does a cut between two pieces change nothing? Bytes of unknown characters never merge."""
        plain = self.vocabulary.mergeable
        return not (plain[left] and plain[right]) or self.compatible(left, right)

    def words(self, text: str) -> list[Encoded]:
        """The encoded words of a text; an empty text has none."""
        if not text:
            return []
        return list(map(self.word, self.find_words(SPACE + text.replace(" ", SPACE))))

    def encode(self, text: str) -> list[int]:
        return [int(i) for w in self.words(text) for i in w[1].split(",")]

    def joined(self, ids: Iterable[int]) -> str:
        """The pieces of some ids in a row; runs of bytes read as UTF-8, each bad byte replaced."""
        out = []
        for is_byte, run in groupby(ids, self.byte_of.__contains__):
            if is_byte:
                out.append(bytes(self.byte_of[i] for i in run).decode("utf-8", "each_bad_byte"))
            else:
                out += [self.shown[i] for i in run]
        return "".join(out)

    def spaced(self, joined: str) -> str:
        """Decoded text from joined pieces: the space put before the text is taken off again."""
        return joined.removeprefix(SPACE).replace(SPACE, " ")

    def decode(self, ids: Iterable[int]) -> str:
        return self.spaced(self.joined(ids))


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, sent: Broadcast) -> Encoder:
    """The encoder of this Python worker, kept from task to task."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(sent.value)
    return _encoders[key]


def encode(documents: DataFrame, vocabulary: Vocabulary, keep: bool = False) -> DataFrame:
    """Pieces of every text, and the text that they decode to.

    Returns for every row ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    commas) and ``decoded_sha256``; with ``keep`` also ``ids`` and ``decoded``. Ids are those of
    merging the whole text, without begin or end ids. The space sign U+2581 in a text decodes
    to a space; else the decoded text is the text.

    NULL and empty texts have no ids and decode to the empty text. Rows that repeat are encoded
    each. Very long texts and words are encoded whole. An empty table gives no rows. Other columns are
    ignored.
    """
    rows = narrow(documents, "doc_id", "text")
    sent = documents.sparkSession.sparkContext.broadcast(vocabulary)
    key = hashlib.sha256(repr(vocabulary).encode()).hexdigest()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep else [])]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, sent)
        for batch in batches:
            counts, id_digests, text_digests, all_ids, decoded = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                words = encoder.words(text or "")
                back = encoder.spaced("".join([w[2] for w in words]))
                counts.append(sum([w[0] for w in words]))
                id_digests.append(hashlib.sha256(",".join([w[1] for w in words]).encode()).hexdigest())
                text_digests.append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
                if keep:
                    all_ids.append([int(i) for w in words for i in w[1].split(",")])
                    decoded.append(back)
            columns = [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
            if keep:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(encoded, schema + (", ids array<int>, decoded string" if keep else ""))
