"""SentencePiece encoding and decoding as shortest paths through weighted transducers.

Three transducers are compiled from the model file.  The normaliser maps a space to the word mark
and puts one before the text.  The lexicon maps every piece to its id at the cost of its negated
score; a character that no piece has maps to the ids of its bytes.  For models trained by merging
pairs, the grammar lets piece b follow piece a only if merging the text of both gives a and b again.
That makes the path through lexicon and grammar unique, and it is the segmentation that merging
gives.  Composition with an input is done on the fly: states are (place, last piece), weights add
along a path and the least is kept, which is the tropical semiring.

No piece has a word mark after another character, so the lattice of a text is a chain of lattices,
one per word, that meet in a single state.  They are solved apart and remembered.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: words (twice, see ``word``) and pairs of pieces that a worker remembers; longer words are solved each time
REMEMBERED_WORDS = 250_000
REMEMBERED_PAIRS = 1_000_000
REMEMBERED_LENGTH = 48

#: field numbers and values of the model file's public format
PIECES, TRAINER, NORMALISER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2

#: last pieces that are none, and the weight of a character that no piece has
START, FALLBACK = -2, -1
PENALTY, INFINITE = 1e6, float("inf")

_models: dict[str, Transducer] = {}


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a message: an integer, or bytes for all that has a length."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


class Transducer:
    """The compiled model of one file."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(fields(file.read()))
        self.pieces: list[tuple[str, float, int]] = []
        settings = {TRAINER: {}, NORMALISER: {}}
        for number, value in parts:
            if number == PIECES:
                piece = dict(fields(value))
                score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number in settings:
                settings[number] = dict(fields(value))
        trainer, normaliser = settings[TRAINER], settings[NORMALISER]
        kinds = {kind for _, _, kind in self.pieces}
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or USER_DEFINED in kinds:
            raise ValueError("models with a character map, space removal or user-defined pieces are not supported")
        if any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind in (NORMAL, UNUSED)):
            raise ValueError("models with pieces across words are not supported")
        self.prefix = bool(normaliser.get(3, 1))
        self.merges = trainer.get(3, UNIGRAM) == MERGES
        self.ids = {piece: i for i, (piece, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        self.cost = [-score for _, score, _ in self.pieces]
        self.unknown = next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), 0)
        self.bytes = {int(piece[3:5], 16): i for i, (piece, _, kind) in enumerate(self.pieces) if kind == BYTE}
        # the lexicon as a trie; a piece that ends at a node stands under the empty text
        self.trie: dict = {}
        for piece, i in self.ids.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
        self.text = [self._text(piece, kind) for piece, _, kind in self.pieces]
        self.known_pairs: dict[int, bool] = {}
        self.known_words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def _text(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if kind == CONTROL else piece.replace(MARK, " ").encode()

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, the leftmost of equals, until none make a piece."""
        parts = list(text)
        while len(parts) > 1:
            best = min(
                ((self.cost[self.ids[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ids),
                default=None,
            )
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, a: int, b: int) -> bool:
        """Whether the grammar has an arc from piece a to piece b; remembered."""
        if len(self.known_pairs) > REMEMBERED_PAIRS:
            self.known_pairs.clear()
        x, y = self.pieces[a][0], self.pieces[b][0]
        known = self.known_pairs[a << 20 | b] = self.merged(x + y) == [x, y]
        return known

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]

    def shortest_path(self, word: str) -> tuple[bytes, float]:
        """Ids as 32-bit integers and the cost of the best path over one word.

        One state is kept per place: the grammar leaves at most one piece that can end there, and
        without a grammar the last piece doesn't matter for what follows.
        """
        n = len(word)
        cost, last, back = [0.0] + [INFINITE] * n, [START] * (n + 1), [0] * (n + 1)
        pairs, own, merges = self.known_pairs, self.cost, self.merges
        for start in range(n):
            here = cost[start]
            if here == INFINITE:
                continue
            before, node, end = last[start], self.trie, start
            while end < n:
                node = node.get(word[end])
                if node is None:
                    break
                end += 1
                i = node.get("")
                if i is not None and here + own[i] < cost[end]:
                    if merges and before >= 0:
                        known = pairs.get(before << 20 | i)
                        if not (self.follows(before, i) if known is None else known):
                            continue
                    cost[end], last[end], back[end] = here + own[i], i, start
            if word[start] not in self.ids and here + PENALTY < cost[start + 1]:
                cost[start + 1], last[start + 1], back[start + 1] = here + PENALTY, FALLBACK, start
        place, path = n, []
        while place:
            if last[place] == FALLBACK:
                path.extend(reversed(self.fallback(word[back[place]])))
            else:
                path.append(last[place])
            place = back[place]
        path.reverse()
        return array("i", path).tobytes(), cost[n]

    def word(self, word: str) -> bytes:
        """Ids of one word, remembered in two generations so that frequent words stay."""
        known = self.older_words.get(word)
        if known is None:
            known = self.shortest_path(word)[0]
        if len(word) <= REMEMBERED_LENGTH:
            if len(self.known_words) >= REMEMBERED_WORDS:
                self.older_words, self.known_words = self.known_words, {}
            self.known_words[word] = known
        return known

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        normal = (MARK if self.prefix else "") + text.replace(" ", MARK)
        known = self.known_words
        return np.frombuffer(b"".join([known.get(w) or self.word(w) for w in _PART.findall(normal)]), np.int32)

    def decode(self, ids) -> str:
        """The inverse transducer: pieces to text, word marks to spaces, without the one before the text."""
        out = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.prefix and out.startswith(" ") else out


def transducer(path: str) -> Transducer:
    if path not in _models:
        _models[path] = Transducer(path)
    return _models[path]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, ids, decoded, round_trip) of every whole text.

    A null or empty text has no ids and decodes to the empty text.  ``round_trip`` says whether the
    decoded text is the input (a null counts as empty); it is false only for texts that hold the
    word mark itself, which decodes to a space.  Repeated documents give repeated rows.  Other
    columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(model_path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = part.column("text").to_pylist()
                ids = [model.encode(t) for t in texts]
                decoded = [model.decode(i.tolist()) for i in ids]
                places = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.ListArray.from_arrays(places, pa.array(np.concatenate(ids))),
                        pa.array(decoded, pa.string()),
                        pa.array([d == (t or "") for d, t in zip(decoded, texts, strict=True)]),
                    ],
                    names=["doc_id", "ids", "decoded", "round_trip"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(work, "doc_id bigint, ids array<int>, decoded string, round_trip boolean")


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, text) of rows with doc_id and ids; null ids decode to null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(model_path)
        for batch in batches:
            texts = [None if i is None else model.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(work, "doc_id bigint, text string")
