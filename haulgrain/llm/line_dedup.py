"""Line dedup by winnowing: repeated runs of lines go, their first occurrence stays.

The lines of a text that hold anything are a sequence of hashes (spaces at the ends and the case of
A-Z don't count).  Of every ``RUN`` neighbouring lines the smallest hash is selected as the window's
fingerprint, so any run of ``RUN`` lines that two texts share is guaranteed to share a fingerprint
at the same place.  Fingerprints that occur once are dropped; the positions of the others are joined
with the first position that has the same lines around the fingerprint.  Each such match is extended
both ways along its diagonal to the longest common run, and that run is deleted where it comes later.

Each position is joined with one earlier position only, so a run that a third of all documents share
makes as many rows as it has occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from haulgrain.llm import kernel as K
from haulgrain.llm.shared import cut

#: lines of a window; a repeated run is found from this length on
RUN = 3
#: rows whose texts a worker rebuilds at a time
ROWS_A_PIECE = 256

KEY = ("_doc_key", "_text_key")
FINGERPRINTS = "_doc_key bigint, _text_key bigint, fingerprint bigint, at int, windows array<struct<start:int,value:bigint>>"


def keys_of() -> list[Column]:
    """Repeated rows share the key: they are one document.  Documents without an id come last."""
    last = F.lit((1 << 63) - 1)
    return [F.coalesce(F.col("doc_id").cast("bigint"), last).alias(KEY[0]), F.xxhash64("text").alias(KEY[1])]


def filled_lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lines that are not blank, with their text, and where each line starts and ends."""
    starts, ends, first = K.split(buf, offsets, 10)
    owner = K.owners(first)
    filled = K.NON_SPACE[buf]
    at = np.flatnonzero(filled)
    lo = np.searchsorted(at, starts)
    hi = np.searchsorted(at, ends)
    some = hi > lo
    starts, ends, owner, lo, hi = starts[some], ends[some], owner[some], lo[some], hi[some]
    hashes = K.span_hash(K.prefix_hash(K.LOWER[buf]), at[lo], at[hi - 1] + 1) if len(lo) else np.zeros(0, np.uint64)
    return hashes, owner, starts, ends


def winnowed(hashes: np.ndarray, first: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``run`` lines: its hash, its first line and the line of its rightmost minimum."""
    values, at, _ = K.grams(hashes, first, run)
    if not len(at):
        return values, at, at
    inside = np.stack([hashes[at + j] for j in range(run - 1, -1, -1)])
    return values, at, at + run - 1 - np.argmin(inside, axis=0)


def fingerprints(docs: DataFrame, run: int = RUN) -> DataFrame:
    """One row per selected line with the windows it was selected for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = pa.struct([("start", pa.int32()), ("value", pa.int64())])
        for batch in batches:
            for lo, hi, buf, offsets in K.chunks(batch.column("text")):
                hashes, owner, _, _ = filled_lines(buf, offsets)
                first = np.searchsorted(owner, np.arange(hi - lo + 1))
                values, at, chosen = winnowed(hashes, first, run)
                # windows stand in order and so do their chosen lines, but for ties, which are settled rightmost
                heads = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1])) if len(chosen) else chosen
                rows = owner[chosen[heads]]
                base = first[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(lo, hi - lo).take(pa.array(rows)) for k in KEY),
                        pa.array(K.signed(hashes[chosen[heads]])),
                        pa.array((chosen[heads] - base[chosen[heads]]).astype(np.int32)),
                        pa.ListArray.from_arrays(
                            np.append(heads, len(at)).astype(np.int32),
                            pa.StructArray.from_arrays(
                                [pa.array((at - base[at]).astype(np.int32)), pa.array(K.signed(values))], fields=list(window)
                            ),
                        ),
                    ],
                    names=[*KEY, "fingerprint", "at", "windows"],
                )

    return docs.where("text is not null").select(*keys_of(), "text").mapInArrow(work, FINGERPRINTS)


def repeated_windows(docs: DataFrame, run: int = RUN) -> DataFrame:
    """Rows (key, starts): first lines of the windows that occur earlier."""
    marks = cut(fingerprints(docs, run).distinct())
    common = marks.groupBy("fingerprint").agg(F.count("*").alias("n")).where("n > 1").select("fingerprint")
    windows = marks.join(common, "fingerprint", "left_semi").select(*KEY, F.explode("windows").alias("w")).select(*KEY, "w.*")
    place = F.struct(*KEY, "start")
    firsts = windows.groupBy("value").agg(F.min(place).alias("source"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = windows.join(firsts, "value").where(place != F.col("source"))
    return later.groupBy(*KEY).agg(F.array_sort(F.collect_list("start")).alias("starts"))


def runs_of(starts: list[int], run: int) -> list[tuple[int, int]]:
    """Matches of windows that touch extend each other to one run of lines, end exclusive."""
    out: list[tuple[int, int]] = []
    for start in starts:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], start + run)
        else:
            out.append((start, start + run))
    return out


def without_runs(text: str, starts: list[int], run: int) -> tuple[str, int, list[tuple[int, int]]]:
    """The text without the lines of the runs, its number of filled lines, and the runs."""
    runs, lines, number = runs_of(starts, run), text.split("\n"), 0
    gone = {i for a, b in runs for i in range(a, b)}
    kept = []
    for line in lines:
        if line.strip(" \t\x0b\x0c\r"):
            if number not in gone:
                kept.append(line)
            number += 1
        else:
            kept.append(line)
    return ("\n".join(kept) if gone else text), number, runs


def line_dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """All columns of the documents with the text after removal, and n_lines, n_deleted, runs.

    Lines that are not blank are compared without the spaces at their ends and without the case of
    A-Z.  A line is deleted if it lies in a run of at least ``run`` such lines that also occurs
    earlier, by doc_id and then by place in the text; blank lines between stay.  ``runs`` names the
    deleted runs as ``start-end`` among these lines, end exclusive.  Repeated rows (same id and
    text) are one document and get the same result; documents without an id come last.  A null text
    stays null with no lines; an empty one stays empty.
    """
    found = repeated_windows(docs, run)
    keyed = docs.withColumns(dict(zip(KEY, keys_of(), strict=True)))
    clash = {c: f"_own_{c}" for c in ("n_lines", "n_deleted", "runs", "starts") if c in docs.columns}
    joined = keyed.withColumnsRenamed(clash).join(found, list(KEY), "left").drop(*KEY)
    made = StructType(
        [*joined.drop("starts").schema, *(StructField(c, LongType()) for c in ("n_lines", "n_deleted")), StructField("runs", StringType())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (b.slice(lo, ROWS_A_PIECE) for b in batches for lo in range(0, b.num_rows, ROWS_A_PIECE))
        for batch in pieces:
            texts, rows = [], []
            for text, starts in zip((t.as_py() for t in batch.column("text")), batch.column("starts").to_pylist(), strict=True):
                cleaned, n, runs = without_runs(text or "", starts or [], run)
                texts.append(None if text is None else cleaned)
                rows.append((n, sum(b - a for a, b in runs), ",".join(f"{a}-{b}" for a, b in runs)))
            out = batch.drop_columns(["starts"])
            out = out.set_column(out.schema.get_field_index("text"), "text", pa.array(texts, batch.column("text").type))
            n, deleted, runs = zip(*rows, strict=True)
            for name, values, kind in (("n_lines", n, pa.int64()), ("n_deleted", deleted, pa.int64()), ("runs", runs, pa.string())):
                out = out.append_column(name, pa.array(values, kind))
            yield out

    return joined.mapInArrow(work, made)


def documents_without_repeated_lines(docs: DataFrame, run: int = RUN) -> DataFrame:
    """The documents with their texts shortened and ``n_chars``, where there is one, brought up to date.

    A document that loses all its words goes: all of it stands in earlier documents.  One that had
    none before stays.
    """
    done = line_dedup(docs, run)
    worded = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rest = done.where((F.col("n_deleted") == 0) | worded)
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.when(F.col("n_deleted") == 0, F.col("n_chars")).otherwise(F.length("text")))
    back = {f"_own_{c}": c for c in ("n_lines", "n_deleted", "runs", "starts") if c in docs.columns}
    return rest.drop("n_lines", "n_deleted", "runs").withColumnsRenamed(back).select(docs.columns)
