"""Token ids as ORC files: run-length encoded integers, row indexes and Bloom filters on document ids.

Documents are dealt out by ranges of their id and sorted, so every stripe and row group covers a
narrow range of ids: a lookup skips files and stripes by their minimum and maximum and row groups
by the Bloom filter, and a full read goes stripe by stripe in parallel.  Integer columns are
written with ORC's own run-length encoding.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ORC settings of the files
STRIPE_BYTES = 16 << 20
ROWS_A_GROUP = 5_000
FALSE_POSITIVES = 0.01
#: encoded words that a worker remembers
REMEMBERED = 400_000

FILE_COLUMNS = "part int, doc_id bigint, start_in_part bigint, n_tokens bigint, ids array<int>"

#: marks that may stand behind a word; they and the letters before them are always apart
MARKS = ".,;:!?)]}\"#*$%&|>"
#: letters from here on go the whole way, as lower case may depend on their surroundings
LATIN_END = "\u0370"
#: the tokenizer's public byte alphabet: printable bytes stand for themselves, the others follow from 256 on
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """The tokenizer of one file, with the ids of the words it has met lately.

    Space, tab, line feed and carriage return separate words for the tokenizer too, so the ids of a
    text are those of the stretches between them, one after the other.  A word of Latin letters,
    with or without marks behind it, goes straight to the tokenizer's model in lower case and in its
    byte alphabet; all other words take the whole way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}
        self.letters: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def whole(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def simple(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters and marks behind it; None for any other word."""
        head = word.rstrip(MARKS)
        low, plain = head.lower(), head.isascii()
        ids = self.letters.get(low) if plain else None
        if ids is None:
            if not (head.isalpha() and (plain or low.isalpha() and max(head) < LATIN_END and is_normalized("NFC", head))):
                return None
            pieces = self.model.tokenize(low if plain else low.encode().decode("latin-1").translate(BYTE_LETTERS))
            ids = self.letters[low] = array("I", [x.id for x in pieces]).tobytes()
        if len(head) == len(word):
            return ids
        tail = word[len(head) :]
        if tail not in self.marks:
            if len(self.marks) >= 10_000:
                self.marks = {}
            self.marks[tail] = self.whole([tail])[0]
        return ids + self.marks[tail]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.letters = {"": b""}, {}
        known, other = self.known, []
        for word in {w for text in words for w in text if w not in known}:
            ids = self.simple(word)
            if ids is None:
                other.append(word)
            else:
                known[word] = ids
        for at in range(0, len(other), 10_000):
            part = other[at : at + 10_000]
            known.update(zip(part, self.whole(part), strict=True))
        return [b"".join(map(known.__getitem__, text)) for text in words]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def runs(texts: pa.Array, limit: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Rows whose texts have a few megabytes together."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    row = 0
    while row < len(sizes):
        end, total = row, 0
        while end < len(sizes) and (end == row or total + sizes[end] <= limit):
            total += sizes[end]
            end += 1
        yield row, end
        row = end


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Rows of the file format, in ascending order of doc_id over all partitions; nulls come first."""
    tail = np.array([end_id], "<u4").tobytes()
    names = [c.split()[0] for c in FILE_COLUMNS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        own = encoder(tokenizer_path)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi in runs(texts):
                ids = [x + tail for x in own.encode(texts.slice(lo, hi - lo).to_pylist())]
                counts = np.array([len(x) // 4 for x in ids])
                ends = np.cumsum(counts)
                values = pa.array(np.frombuffer(b"".join(ids), "<u4").view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(hi - lo, part, np.int32)),
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(start + ends - counts, pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), values),
                    ],
                    names=names,
                )
                start += int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return rows.mapInArrow(work, FILE_COLUMNS)


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> None:
    """Encode every document, append ``end_id`` and write the ids below ``folder``.

    A null or empty text has only the end id.  Documents without an id come first; documents with
    the same id follow each other in the order of a hash of their texts.  An empty table writes
    files without rows.
    """
    writer = encoded(docs, tokenizer_path, end_id).write.format("orc")
    for key, value in {
        "compression": "zstd",
        "orc.stripe.size": STRIPE_BYTES,
        "orc.row.index.stride": ROWS_A_GROUP,
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": FALSE_POSITIVES,
    }.items():
        writer = writer.option(key, value)
    writer.save(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files; start is the number of ids before the document.

    A filter on doc_id reaches the scan, which prunes files, stripes and row groups.
    """
    files = spark.read.schema(FILE_COLUMNS).orc(folder)
    # one row per written partition: their number, not the number of documents, bounds what is broadcast
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    return files.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"
    )


def checksums(read: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the CRC of the ids as little-endian 32-bit integers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")
            place = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(place[:-1], place[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "start", "n_tokens")] + [pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return read.mapInArrow(work, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
