"""Benchmark decontamination by Wu-Manber search over words.

A window is ten consecutive words of a benchmark item; an item of fewer words is one window.  All
windows of one length are searched together: a block is two neighbouring words, the shift table
says for each block how far the next place lies at which a window can end, and blocks that no
window has allow the longest jump.  Where the shift is zero, the block picks the bucket of windows
that end with it, the hash of a window's words picks the candidates, and the words themselves are
compared.  A text is cut into stretches that are searched side by side, each with a cursor of its
own, so the jumps run vectorised.

The windows are the query set: they are dealt into passes of at most ``WINDOWS_A_PASS`` windows,
each pass scans all documents with the tables of its own windows, and no pass shuffles a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrain.llm import kernel as K

WINDOW = 10
#: bound of what one pass broadcasts: 100,000 windows of ten words are about 20 MB
WINDOWS_A_PASS = 100_000
STRETCH = 64

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

HITS = "array<struct<start:int,end:int>>"


@dataclass
class Group:
    """Tables of all windows of one length."""

    length: int
    blocks: np.ndarray = field(default=None)  # sorted hashes of the blocks that windows have
    shifts: np.ndarray = field(default=None)  # distance from a block to the end of a window
    names: np.ndarray = field(default=None)  # sorted hashes of whole windows
    windows: list[list[tuple[bytes, int]]] = field(default_factory=list)  # by name: (text of the window, item)


def block_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the block that ends at each word but the first ``width - 1``."""
    if width == 1:
        return K.mix(words)
    return K.mix(words[:-1] * np.uint64(0xD1342543DE82EF95) + words[1:])


def window_hash(words: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    value = np.zeros(len(ends), np.uint64)
    for j in range(length):
        value = value * np.uint64(0xD1342543DE82EF95) + words[ends - (length - 1) + j]
    return K.mix(value)


def compiled(windows: list[tuple[tuple[str, ...], int]]) -> list[Group]:
    """Tables for (words, item) windows, one group per length."""
    groups = []
    for length in sorted({len(w) for w, _ in windows}):
        own = sorted({(w, item) for w, item in windows if len(w) == length})
        width = min(2, length)
        texts = [" ".join(w).encode() for w, _ in own]
        buf, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        starts, ends, _ = K.spans(K.ALNUM[buf], offsets)
        words = K.span_hash(K.prefix_hash(buf), starts, ends).reshape(len(own), length)
        least: dict[int, int] = {}
        for j in range(width - 1, length):
            for h in block_hash(words[:, j - width + 1 : j + 1].reshape(-1), width)[:: width if width > 1 else 1].tolist():
                least[h] = min(least.get(h, length), length - 1 - j)
        blocks = np.array(sorted(least), np.uint64)
        named: dict[int, list[tuple[bytes, int]]] = {}
        names = window_hash(words.reshape(-1), np.arange(len(own)) * length + length - 1, length)
        for name, text, (_, item) in zip(names.tolist(), texts, own, strict=True):
            named.setdefault(name, []).append((text, item))
        order = sorted(named)
        groups.append(
            Group(length, blocks, np.array([least[h] for h in blocks.tolist()]), np.array(order, np.uint64), [named[n] for n in order])
        )
    return groups


def looked_up(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    place = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return place, table[place] == values


def occurrences(group: Group, words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end word, place among the names) of all candidates: shift to them, then compare window hashes."""
    width, n = min(2, group.length), len(words)
    if n < group.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = block_hash(words, width)
    cursor = np.arange(group.length - 1, n, STRETCH)
    stop = np.append(cursor[1:], n)
    jump = group.length - width + 1
    found = []
    while len(cursor):
        place, known = looked_up(group.blocks, hashes[cursor - width + 1])
        shift = np.where(known, group.shifts[place], jump)
        found.append(cursor[shift == 0])
        cursor = cursor + np.maximum(shift, 1)
        on = cursor < stop
        cursor, stop = cursor[on], stop[on]
    ends = np.concatenate(found)
    ends = ends[owner[ends] == owner[ends - group.length + 1]]
    place, known = looked_up(group.names, window_hash(words, ends, group.length))
    return ends[known], place[known]


def search(groups: list[Group], text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list, list]]:
    """For runs of rows: first row, end row, words of each text, its hit stretches and its items."""
    for lo, hi, raw, offsets in K.chunks(text):
        buf = K.LOWER[raw]
        starts, ends, first = K.spans(K.ALNUM[buf], offsets)
        words, owner = K.span_hash(K.prefix_hash(buf), starts, ends), K.owners(first)
        hits: list[list[tuple[int, int]]] = [[] for _ in range(hi - lo)]
        items: list[list[int]] = [[] for _ in range(hi - lo)]
        for group in groups:
            for end, place in zip(*(x.tolist() for x in occurrences(group, words, owner)), strict=True):
                begin, row = end - group.length + 1, int(owner[end])
                own = b" ".join(buf[starts[i] : ends[i]].tobytes() for i in range(begin, end + 1))
                which = [item for window, item in group.windows[place] if window == own]
                if which:
                    hits[row].append((begin - int(first[row]), end + 1 - int(first[row])))
                    items[row].extend(which)
        yield lo, hi, np.diff(first), hits, items


def searched(docs: DataFrame, groups: list[Group], last: bool) -> DataFrame:
    """One pass over (doc_id, text, n_words, hits, items): adds what these windows hit; the last drops the text."""
    columns = ["doc_id", *(["text"] * (not last)), "n_words", "hits", "items"]
    types = {"doc_id": "bigint", "text": "string", "n_words": "bigint", "hits": HITS, "items": "array<bigint>"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for lo, hi, n_words, hits, items in search(groups, batch.column("text")):
                before = batch.slice(lo, hi - lo)
                had, named = before.column("hits").to_pylist(), before.column("items").to_pylist()
                hits = [merged([(x["start"], x["end"]) for x in a] + b) for a, b in zip(had, hits, strict=True)]
                made = {
                    "doc_id": before.column("doc_id"),
                    "text": before.column("text"),
                    "n_words": pa.array(n_words, pa.int64()),
                    "hits": pa.array([[{"start": x, "end": y} for x, y in h] for h in hits], stretch),
                    "items": pa.array([sorted({*a, *b}) for a, b in zip(named, items, strict=True)], pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_arrays([made[c] for c in columns], names=columns)

    return docs.mapInArrow(work, ", ".join(f"{c} {types[c]}" for c in columns))


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching stretches made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(hits):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (words, item_id): all windows of ten words, or all words of an item with fewer."""
    words = F.regexp_extract_all(F.translate("text", *LETTERS), F.lit(WORD), F.lit(0))
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("bigint"), words.alias("w"))
    items = items.where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice(F.col("w"), i, WINDOW))
    return items.select(F.explode(windows).alias("words"), "item_id").distinct()


def passes(benchmark: DataFrame, per_pass: int) -> list[list[Group]]:
    """The compiled tables of each pass; one pass without windows if the benchmark has none."""
    windows = benchmark_windows(benchmark)
    number = max(1, -(-windows.count() // per_pass))
    dealt = windows.withColumn("pass", F.pmod(F.xxhash64("words", "item_id"), F.lit(number)))
    own = (dealt.where(F.col("pass") == i).collect() for i in range(number))
    return [compiled([(tuple(r["words"]), r["item_id"]) for r in rows]) for rows in own]


def contamination(docs: DataFrame, benchmark: DataFrame, per_pass: int = WINDOWS_A_PASS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits, items.

    A document word inside any occurrence of a window is hit; ``hits`` are the stretches of hit
    words (end exclusive), ``items`` the items whose windows occur.  A null, empty or wordless text
    has no words and is clean.  Benchmark rows without an id, a text or a word have no window;
    repeated items and windows count once.  Repeated documents give repeated rows.  Other columns
    are ignored.
    """
    found = docs.select(
        F.col("doc_id").cast("bigint"), "text", F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(HITS).alias("hits"), F.array().cast("array<bigint>").alias("items"),
    )
    rounds = passes(benchmark, per_pass)
    for i, groups in enumerate(rounds):
        found = searched(found, groups, last=i == len(rounds) - 1)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "hits", "items",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, per_pass: int = WINDOWS_A_PASS) -> DataFrame:
    """The documents in which no window occurs; all columns and repeated rows as they came."""
    for groups in passes(benchmark, per_pass):

        def work(batches: Iterator[pa.RecordBatch], groups=groups) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, _, hits, _ in search(groups, batch.column("text")):
                    yield batch.slice(lo, hi - lo).filter(pa.array([not h for h in hits]))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
