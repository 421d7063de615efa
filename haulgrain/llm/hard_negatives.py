"""Hard negatives from Hilbert-ordered blocks with zone maps.

All vectors are scaled to integers, sorted by label and by their place on a Hilbert curve, and written
as Parquet blocks of some hundred vectors.  A block carries a zone map: the smallest and largest value
of each dimension, its labels and its smallest id.  For an anchor, interval arithmetic on the zone map
bounds the scores of all vectors of a block from both sides.

Anchors are packed in groups of neighbours on the curve.  A search streams the blocks that its group
must read past the anchors of the group (``_search``): one matrix product per block and the anchors
that still need it.  An anchor needs a block if the bounds allow a score inside one of its score
windows that would enter the best so far.

1. Positives: the best vectors of the anchor's own label, in one window without limits.
2. Each positive's score opens a window for negatives.  The zone maps alone say which blocks the windows
   of a group must read (``_must_read``); only these are read.

Each group is split into ``SLICES`` tasks by block, and each of them keeps the best of its share, so the
rows that leave a search grow with the anchors and not with anchors x vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulgrain.llm.shared import cut, new_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW_PCT, HIGH_PCT = 30, 90

#: bits per dimension of the curve
CURVE_BITS = 3
BLOCK_BYTES = 1 << 17
GROUP_BYTES = 1 << 21
GROUP_ANCHORS = 4096
SLICES = 8
#: scaled components of this size or more count as not finite, so that scores keep to 64 bits
TOO_LARGE = 1 << 24

_NONE = np.iinfo(np.int64).min


def relabelled(rows: DataFrame) -> DataFrame:
    """Every seventh vector with the next label of ten, as a stand-in for noisy labels."""
    label = F.col("label").cast("bigint")
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))


def hilbert_keys(values: np.ndarray, scale: int = SCALE, bits: int = CURVE_BITS) -> list[bytes]:
    """Place of each row on a Hilbert curve, as bytes that sort like the curve.

    A component becomes one of 2^bits levels by its angle, so any range of values has levels.  The
    levels are turned into the curve's transposed index: from the highest bit down each axis either
    flips the lower bits of the first axis or swaps them with its own; a Gray code of the axes follows.
    """
    n, d = values.shape
    if not d:
        return [b""] * n
    turn = np.arctan(values * (np.sqrt(d) / scale)) / np.pi + 0.5
    axes = np.minimum((turn * (1 << bits)).astype(np.uint8), (1 << bits) - 1).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, below = np.uint8(1 << level), np.uint8((1 << level) - 1)
        for axis in range(d):
            flip = (axes[axis] & bit) != 0
            swap = np.where(flip, 0, (axes[0] ^ axes[axis]) & below).astype(np.uint8)
            axes[0] ^= np.where(flip, below, swap)
            if axis:
                axes[axis] ^= swap
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    undo = np.zeros(n, np.uint8)
    for level in range(bits - 1, 0, -1):
        undo ^= np.where(axes[-1] & np.uint8(1 << level), np.uint8((1 << level) - 1), np.uint8(0))
    axes ^= undo
    planes = [(axes >> np.uint8(level)) & 1 for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T, axis=1)
    return [row.tobytes() for row in packed]


POINTS = "dim int, label bigint, curve binary, vec_id bigint, anchor boolean, vector binary"


def points(rows: DataFrame, anchors: Column, scale: int = SCALE) -> DataFrame:
    """Integer vectors of the rows that take part, with their place on the curve."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten().cast(pa.float64())
            x = np.asarray(flat.fill_null(float("nan")))
            with np.errstate(invalid="ignore", over="ignore"):
                scaled = np.floor(x * scale)
                bad = ~(np.abs(scaled) < TOO_LARGE)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            good = np.bincount(owner[bad], minlength=len(sizes)) == 0
            first = np.cumsum(sizes) - sizes
            for d in np.unique(sizes[good]):
                at = np.flatnonzero(good & (sizes == d))
                values = scaled[first[at][:, None] + np.arange(d)].reshape(len(at), d)
                taken = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(at), d, np.int32)),
                        taken.column("label"),
                        pa.array(hilbert_keys(values, scale), pa.binary()),
                        taken.column("vec_id"),
                        taken.column("anchor"),
                        pa.array([v.tobytes() for v in values.astype(np.int32)], pa.binary()),
                    ],
                    names=[c.split()[0] for c in POINTS.split(", ")],
                )

    chosen = rows.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return chosen.where("vec_id is not null and label is not null and embedding is not null").mapInArrow(work, POINTS)


BLOCKS = (
    "part int, block bigint, dim int, size int, anchors int, label_lo bigint, label_hi bigint, least_id bigint, "
    "lo binary, hi binary, ids binary, labels binary, anchor binary, vectors binary"
)


def _block(part: int, number: int, d: int, columns: list[np.ndarray]) -> dict:
    ids, labels, anchor, vectors = columns
    whole = {"lo": vectors.min(axis=0), "hi": vectors.max(axis=0), "ids": ids, "labels": labels, "anchor": anchor, "vectors": vectors}
    return {
        "part": part,
        "block": part << 32 | number,
        "dim": d,
        "size": len(ids),
        "anchors": int(anchor.sum()),
        "label_lo": int(labels.min()),
        "label_hi": int(labels.max()),
        "least_id": int(ids.min()),
    } | {k: v.tobytes() for k, v in whole.items()}


def blocks(sorted_points: DataFrame) -> DataFrame:
    """Packs points that come in curve order; a repeated row is packed once."""
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * 6]
    schema = pa.schema(list(zip([c.split()[0] for c in BLOCKS.split(", ")], kinds, strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, d, held, rows, last = TaskContext.get().partitionId(), 0, None, [], 0, None

        def packed() -> pa.RecordBatch:
            nonlocal number, held, rows
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            row = _block(part, number, d, columns)
            number, held, rows = number + 1, [], 0
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            dims, labels = np.asarray(batch.column("dim")), np.asarray(batch.column("label"))
            ids, anchor = np.asarray(batch.column("vec_id")), np.asarray(batch.column("anchor").cast(pa.uint8()))
            data = batch.column("vector").to_pylist()
            edge = np.flatnonzero(np.append(True, (dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])))
            for a, b in zip(edge, np.append(edge[1:], len(dims)), strict=True):
                least = max(16, min(1024, BLOCK_BYTES // (4 * max(1, int(dims[a])))))
                if held and (dims[a] != d or (labels[a] != held[-1][1][-1] and rows >= least // 4)):
                    yield packed()
                d = int(dims[a])
                keep = []
                for i in range(a, b):
                    name = (d, labels[i], ids[i], data[i])
                    if name != last:
                        keep.append(i)
                    last = name
                while keep:
                    now, keep = keep[: least - rows], keep[least - rows :]
                    vectors = np.frombuffer(b"".join(data[i] for i in now), np.int32).reshape(len(now), d)
                    held.append((ids[now], labels[now], anchor[now], vectors))
                    rows += len(now)
                    if rows >= least:
                        yield packed()
        if held:
            yield packed()

    return sorted_points.mapInArrow(work, BLOCKS)


GROUPS = "grp bigint, dim int, label_lo bigint, label_hi bigint, ids binary, labels binary, vectors binary"


def anchor_groups(candidates: DataFrame, n_anchors: int, parts: int, widest: int) -> DataFrame:
    """Anchors of neighbouring blocks packed together, at most ``GROUP_ANCHORS`` or ``GROUP_BYTES`` a group."""
    most = max(16, min(GROUP_ANCHORS, GROUP_BYTES // (4 * max(1, widest))))
    groups = -(-n_anchors // most)

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["anchor"], np.uint8))
                vectors = np.frombuffer(r["vectors"], np.int32).reshape(r["size"], r["dim"])[at]
                rows.append(
                    (r["part"] * groups // parts, r["dim"], r["block"])
                    + (np.frombuffer(r["ids"], np.int64)[at].tobytes(), np.frombuffer(r["labels"], np.int64)[at].tobytes(), vectors.tobytes())
                )
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["near", "dim", "block", "ids", "labels", "vectors"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, now, held, rows = TaskContext.get().partitionId(), 0, None, [], 0

        def group() -> pa.RecordBatch:
            nonlocal number, held, rows
            ids, labels, vectors = (b"".join(c) for c in zip(*held, strict=True))
            of = np.frombuffer(labels, np.int64)
            row = [part << 32 | number, now[1], int(of.min()), int(of.max()), ids, labels, vectors]
            number, held, rows = number + 1, [], 0
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in GROUPS.split(", ")])

        for batch in batches:
            for r in batch.to_pylist():
                if held and ((r["near"], r["dim"]) != now or rows >= most):
                    yield group()
                now = (r["near"], r["dim"])
                held.append((r["ids"], r["labels"], r["vectors"]))
                rows += len(r["ids"]) // 8
        if held:
            yield group()

    of_blocks = candidates.where("anchors > 0").select("part", "block", "dim", "size", "ids", "labels", "anchor", "vectors")
    rows = of_blocks.mapInArrow(taken, "near bigint, dim int, block bigint, ids binary, labels binary, vectors binary")
    return rows.repartition("near", "dim").sortWithinPartitions("near", "dim", "block").mapInArrow(packed, GROUPS)


class _Anchors:
    """The anchors of a group with their score windows, and the best scores of each window so far.

    ``windows`` are rows (at, low, high) with the anchor's place in the group.
    """

    def __init__(self, row: dict, k: int, same: bool):
        d = row["dim"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(len(self.ids), d).astype(np.float64)
        self.up, self.down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        self.reach = float(np.abs(self.vectors).max(initial=0))
        self.k, self.same = k, same
        listed = row["windows"]
        self.windows = listed
        self.at = np.array([w["at"] for w in listed], np.int64)
        self.low = np.array([w["low"] for w in listed], np.int64)
        self.high = np.array([w["high"] for w in listed], np.int64)
        # number of a window among those of its anchor: each turn takes one window an anchor
        self.turn = np.arange(len(self.at)) - np.searchsorted(self.at, self.at)
        self.best = np.full((len(self.at), k), _NONE)
        self.best_id = np.full((len(self.at), k), np.iinfo(np.int64).max)

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Highest and lowest score of each anchor with a vector inside the zone; zones may be stacked."""
        lo, hi = lo.astype(np.float64).T, hi.astype(np.float64).T
        return self.up @ hi + self.down @ lo, self.up @ lo + self.down @ hi

    def needed(self, upper: np.ndarray, lower: np.ndarray, label_lo: int, label_hi: int, least_id: int) -> np.ndarray:
        """Windows that may take a vector of a block with these bounds."""
        mine = self.labels[self.at]
        fits = (label_lo <= mine) & (mine <= label_hi) if self.same else (label_lo != mine) | (label_hi != mine)
        last, last_id = self.best[:, -1], self.best_id[:, -1]
        top = upper[self.at]
        enters = (top > last) | ((top == last) & (least_id < last_id))
        return fits & (top >= self.low) & (lower[self.at] <= self.high) & enters

    def read(self, row: dict) -> None:
        d = row["dim"]
        lo, hi = np.frombuffer(row["lo"], np.int32), np.frombuffer(row["hi"], np.int32)
        exact = np.float64 if self.reach * float(max(abs(lo).max(initial=0), abs(hi).max(initial=0))) * max(d, 1) < 2.0**53 else np.int64
        if exact is np.float64:
            upper, lower = self.bounds(lo, hi)
            need = self.needed(upper, lower, row["label_lo"], row["label_hi"], row["least_id"])
        else:  # scores this large are worked out in integers, without bounds
            need = np.ones(len(self.at), bool)
        if not need.any():
            return
        ids, labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        vectors = np.frombuffer(row["vectors"], np.int32).reshape(row["size"], d)
        found = []
        for turn in range(int(self.turn[need].max()) + 1):
            windows = np.flatnonzero(need & (self.turn == turn))
            if not len(windows):
                continue
            at = self.at[windows]
            scores = (self.vectors[at].astype(exact) @ vectors.T.astype(exact)).astype(np.int64)
            floor = np.maximum(self.low[windows], self.best[windows, -1])
            hit = (scores >= floor[:, None]) & (scores <= self.high[windows][:, None])
            hit &= (self.labels[at][:, None] == labels) == self.same
            hit &= self.ids[at][:, None] != ids
            r, c = np.nonzero(hit)
            found.append((windows[r], scores[r, c], ids[c]))
        window, score, other = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(window):
            return
        touched = np.unique(window)
        window = np.concatenate([window, np.repeat(touched, self.k)])
        score = np.concatenate([score, self.best[touched].ravel()])
        other = np.concatenate([other, self.best_id[touched].ravel()])
        order = np.lexsort((other, -np.maximum(score, _NONE + 1), window))
        window, score, other = window[order], score[order], other[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        first = place < self.k
        self.best[touched] = score[first].reshape(-1, self.k)
        self.best_id[touched] = other[first].reshape(-1, self.k)


FOUND = "grp bigint, number int, at int, anchor_id bigint, positive_id bigint, positive_score bigint, other_id bigint, score bigint"
_WINDOW = "array<struct<at:int,low:bigint,high:bigint,positive_id:bigint,positive_score:bigint>>"


def _streamed(groups: DataFrame, others: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Each group's row before the rows of ``others`` for that group, in ``SLICES`` shares by block."""
    sliced = groups.withColumns({"share": F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))), "kind": F.lit(0), "block": F.lit(0).cast("bigint")})
    others = others.withColumns({"share": F.pmod(F.xxhash64("block"), F.lit(SLICES)).cast("int"), "kind": F.lit(1)})
    rows = sliced.unionByName(others, allowMissingColumns=True)
    return rows.repartition("grp", "share").sortWithinPartitions("grp", "share", "kind", "block").mapInArrow(work, schema)


def _search(groups: DataFrame, reads: DataFrame, k: int, same: bool) -> DataFrame:
    """The first k vectors of each window among the blocks of ``reads``, per share of a group."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 5]

    def results(grp: int, now: _Anchors) -> pa.RecordBatch:
        window, place = np.nonzero(now.best > _NONE)
        listed = [now.windows[w] for w in window.tolist()]
        columns = [
            np.full(len(window), grp),
            window,
            now.at[window],
            now.ids[now.at[window]],
            pa.array([w["positive_id"] for w in listed], pa.int64()),
            pa.array([w["positive_score"] for w in listed], pa.int64()),
            now.best_id[window, place],
            now.best[window, place],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c).cast(t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, now = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if row["kind"] == 0:
                    if now is not None:
                        yield results(grp, now)
                    grp, now = row["grp"], _Anchors(row, k, same)
                elif len(now.at):
                    now.read(row)
        if now is not None:
            yield results(grp, now)

    return _streamed(groups, reads, work, FOUND)


def _must_read(groups: DataFrame, zones: DataFrame) -> DataFrame:
    """(grp, block) of the blocks that a window of the group may find a negative in, by zone maps alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, now = None, None
        for batch in batches:
            chosen = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    grp, now = row["grp"], _Anchors(row, 1, same=False)
                    continue
                upper, lower = now.bounds(np.frombuffer(row["lo"], np.int32), np.frombuffer(row["hi"], np.int32))
                # beyond 2^53 the bounds are rounded, by less than this
                slack = np.abs(upper) * 2.0**-40 + np.abs(lower) * 2.0**-40
                if now.needed(upper + slack, lower - slack, row["label_lo"], row["label_hi"], row["least_id"]).any():
                    chosen.append((grp, row["block"]))
            if chosen:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*chosen, strict=True)], names=["grp", "block"])

    return _streamed(groups, zones, work, "grp bigint, block bigint")


def hard_negatives(
    rows: DataFrame,
    anchors: Column | None = None,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_pct: int = LOW_PCT,
    high_pct: int = HIGH_PCT,
    scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, embedding).

    The score of two vectors is the inner product of floor(scale x) of their components; higher scores
    come first, ties by smaller vec_id.  An anchor's positives are its first rows of the same label;
    each gets the first rows of other labels that score between ``low_pct`` and ``high_pct`` per cent of
    it.  ``anchors`` says which rows are anchors; left out, those whose vec_id is divisible by 100.

    Rows with a null id, label or vector, or a component that is null, not finite or 2^24 or more after
    scaling, take no part.  Only vectors of one length are compared.  A repeated row counts once; rows
    that share the anchor's vec_id are never its partners, and of different rows with one vec_id each
    has a place of its own.  An empty table, or one without anchors, gives an empty result.  Other
    columns are ignored.
    """
    spark = rows.sparkSession
    anchors = F.col("vec_id") % 100 == 0 if anchors is None else anchors
    order = ["dim", "label", "curve", "vec_id", "vector"]
    placed = cut(points(rows, anchors, scale))
    folder = new_folder(spark, "hard-negatives")
    blocks(placed.repartitionByRange(*order[:-1]).sortWithinPartitions(*order)).write.parquet(f"{folder}/blocks")
    candidates = spark.read.parquet(f"{folder}/blocks")
    n_anchors, last_part, widest = candidates.agg(F.coalesce(F.sum("anchors"), F.lit(0)), F.max("part"), F.max("dim")).first()
    if not n_anchors:
        last_part, widest = 0, 0
    anchor_groups(candidates, n_anchors, last_part + 1, widest).write.parquet(f"{folder}/anchors")
    groups = spark.read.parquet(f"{folder}/anchors")

    # positives: the blocks with a label of the group
    every = "transform(sequence(0, cast(length(ids) / 8 as int) - 1), i -> named_struct('at', i, 'low', {0}, 'high', {1}, 'positive_id', cast(null as bigint), 'positive_score', cast(null as bigint)))"
    open_groups = groups.withColumn("windows", F.expr(every.format(f"cast({-(1 << 62)} as bigint)", f"cast({1 << 62} as bigint)")).cast(_WINDOW))
    named = groups.select("grp", "dim", F.col("label_lo").alias("from_label"), F.col("label_hi").alias("to_label"))
    data = ["block", "dim", "size", "label_lo", "label_hi", "least_id", "lo", "hi", "ids", "labels", "vectors"]
    own = candidates.select(*data).join(named, "dim").where("label_lo <= to_label and label_hi >= from_label").drop("from_label", "to_label")
    best = Window.partitionBy("grp", "number").orderBy(F.desc("score"), "other_id")
    found = _search(open_groups, own, positives, same=True).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)

    # negatives: the blocks that the windows of the positives must read
    share = F.col("score").cast("decimal(20,0)")
    windows = found.select(
        "grp",
        F.struct(
            "at",
            F.ceil(share * low_pct / 100).cast("bigint").alias("low"),
            F.floor(share * high_pct / 100).cast("bigint").alias("high"),
            F.col("other_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
            "rank",
        ).alias("w"),
    ).where("w.low <= w.high")
    listed = windows.groupBy("grp").agg(F.array_sort(F.collect_list("w"), lambda a, b: F.when(a["at"] != b["at"], a["at"] - b["at"]).otherwise(a["rank"] - b["rank"])).alias("w"))
    listed = listed.select("grp", F.expr("transform(w, x -> named_struct('at', x.at, 'low', x.low, 'high', x.high, 'positive_id', x.positive_id, 'positive_score', x.positive_score))").cast(_WINDOW).alias("windows"))
    asking = cut(groups.join(listed, "grp"))
    zones = candidates.select("block", "dim", "label_lo", "label_hi", "least_id", "lo", "hi")
    chosen = cut(_must_read(asking, zones.join(asking.select("grp", "dim"), "dim")))
    reads = candidates.select(*data).join(chosen, "block")
    ranked = _search(asking, reads, negatives, same=False).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
