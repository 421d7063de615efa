"""Near-duplicate documents by one-permutation MinHash.

Each document's word shingles are dealt into ``BINS`` bins by one hash function; a bin keeps its
smallest hash.  Empty bins are filled by optimal densification: bin j tries the bins that a second
hash of (j, attempt) names until it meets one that is not empty, so two documents fill a bin alike
exactly as often as their sets are alike.  ``BANDS`` bands of ``BINS / BANDS`` bins give the bucket
keys; at a similarity of 0.75 all 32 bands miss with a probability below 1e-5.

Documents with the same shingle set are one node from the start.  In a bucket, candidate edges form
stars: the smallest node is compared with all others and then leaves the bucket.  Where the rest
still belongs to several components, a further star is drawn from a member that each bucket picks in
an order of its own, compared with the members of other components only.  A round makes at most one
pair per member of a bucket, so a large group of near copies becomes one component with few pairs.
Stars end, after the third round at the earliest, when few of their pairs are links.

The buckets that then still hold several components are finished exactly: their members are joined
on the rarest of their shingles, so many of them that two similar sets must meet in one (prefix
filter), at places that leave enough shingles behind them (positional filter).  So any two nodes of
a bucket end in one component, or have been compared, or can't be similar enough.  Links are
confirmed on the full sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm import kernel as K
from haulgrain.llm.shared import components, cut

BINS = 128
BANDS = 32
SHINGLE = 5
SIMILARITY_PCT = 75
#: rounds of stars that are drawn even if one of them confirms nothing
LEAST_ROUNDS = 3
#: later rounds go on while at least one in so many pairs is a link
PAIRS_A_LINK = 10

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_BIN_SALT = np.uint64(0x2545F4914F6CDD1D)

SIGNED = "doc_id bigint, n_shingles bigint, key binary, bands array<bigint>"


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z, fewer than k words are one shingle."""
    buf = K.LOWER[buf]
    starts, ends, first = K.spans(K.NON_SPACE[buf], offsets)
    words = K.span_hash(K.prefix_hash(buf), starts, ends)
    hashes, _, gram_first = K.grams(words, first, k)
    sets = []
    for t in range(len(offsets) - 1):
        n = first[t + 1] - first[t]
        if n >= k:
            sets.append(np.unique(hashes[gram_first[t] : gram_first[t + 1]]))
        elif n:
            value = np.array([n], np.uint64)
            for word in words[first[t] : first[t + 1]]:
                value = K.mix(value * np.uint64(31) + word)
            sets.append(value)
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_key(values: np.ndarray) -> bytes:
    """128 bits that name a set: the sum of one mix of its members and the exclusive or of another."""
    low = K.mix(values)
    high = K.mix(values ^ _BIN_SALT)
    return np.array([low.sum(dtype=np.uint64), np.bitwise_xor.reduce(high)], np.uint64).tobytes()


def probe_order(bins: int = BINS, attempts: int = 64) -> np.ndarray:
    """Row a holds, for each bin, the bin that attempt a names."""
    grid = np.arange(bins, dtype=np.uint64)[None, :] + np.uint64(bins) * np.arange(attempts, dtype=np.uint64)[:, None]
    return (K.mix(grid * _BIN_SALT + np.uint64(1)) % np.uint64(bins)).astype(np.int64)


def densified(values: np.ndarray, probes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """One-permutation signature of a set that is not empty."""
    spread = K.mix(values ^ np.uint64(0xA0761D6478BD642F))
    signature = np.full(bins, _EMPTY)
    np.minimum.at(signature, (spread % np.uint64(bins)).astype(np.int64), spread // np.uint64(bins))
    full = signature != _EMPTY
    source = np.arange(bins)
    open_bins = np.flatnonzero(~full)
    for row in probes:
        if not len(open_bins):
            break
        named = row[open_bins]
        source[open_bins] = np.where(full[named], named, source[open_bins])
        open_bins = open_bins[~full[named]]
    if len(open_bins):  # all attempts met empty bins: the full bin next in a fixed order
        filled = np.flatnonzero(full)
        rank = K.mix(filled.astype(np.uint64)[None, :] * np.uint64(bins) + open_bins.astype(np.uint64)[:, None])
        source[open_bins] = filled[np.argmin(rank, axis=1)]
    # a filled bin also carries where it came from, as the values of two bins are not comparable
    return K.mix(signature[source] * np.uint64(bins) + source.astype(np.uint64))


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    value = np.arange(1, bands + 1, dtype=np.uint64)
    for column in signature.reshape(bands, -1).T:
        value = K.mix(value * np.uint64(0x9FB21C651E98DF25) + column)
    return value


def signatures(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, key, bands); key and bands are null for a document without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = probe_order()
        for batch in batches:
            for lo, hi, buf, offsets in K.chunks(batch.column("text")):
                sets = shingle_sets(buf, offsets)
                bands = [K.signed(band_keys(densified(s, probes))) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "key", "bands"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, SIGNED)


def confirmed(pairs: DataFrame, text: DataFrame) -> DataFrame:
    """Those pairs (a, a_key, b, b_key) whose full sets reach the similarity.

    The member's text is joined first and the centre's last, so a centre with many members keeps
    one copy of its own text.  A text is used only if its set has the expected key, which also
    settles repeated document ids.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last = None, None
        for batch in batches:
            a_keys, b_keys = batch.column("a_key").to_pylist(), batch.column("b_key").to_pylist()
            a_text, keep = batch.column("a_text"), np.zeros(batch.num_rows, bool)
            for lo, hi, buf, offsets in K.chunks(batch.column("b_text")):
                for row, right in zip(range(lo, hi), shingle_sets(buf, offsets), strict=True):
                    if a_keys[row] != last_key:
                        (_, _, one, place) = next(K.chunks(a_text.slice(row, 1)))
                        last_key, last = a_keys[row], shingle_sets(one, place)[0]
                        if not len(last) or set_key(last) != last_key:
                            last_key = None
                    if last_key is None or not len(right) or set_key(right) != b_keys[row]:
                        continue
                    both = len(np.intersect1d(last, right, assume_unique=True))
                    keep[row] = 100 * both >= SIMILARITY_PCT * (len(last) + len(right) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(mask) for c in ("a", "b")], names=["u", "v"]
            )

    members = pairs.join(text.withColumnsRenamed({"doc_id": "b", "text": "b_text"}), "b")
    rows = members.join(text.withColumnsRenamed({"doc_id": "a", "text": "a_text"}), "a")
    rows = rows.select("a", "a_key", "a_text", "b", "b_key", "b_text")
    return rows.mapInArrow(work, "u bigint, v bigint").distinct()


def stars(members: DataFrame) -> DataFrame:
    """Distinct pairs (a, a_key, b, b_key) of each bucket's centre with its members of other components."""
    centre, other = F.col("centre"), F.struct("node", "key", "n_shingles", "component")
    swap = F.col("node") < F.col("centre.node")
    rows = members.where("component <> centre.component").select(
        F.when(swap, other).otherwise(centre).alias("x"), F.when(swap, centre).otherwise(other).alias("y")
    )
    # a set too small for the other one can't be similar enough
    fits = 100 * F.least("x.n_shingles", "y.n_shingles") >= SIMILARITY_PCT * F.greatest("x.n_shingles", "y.n_shingles")
    names = {"x.node": "a", "x.key": "a_key", "y.node": "b", "y.key": "b_key"}
    return rows.where(fits).select(*(F.col(c).alias(n) for c, n in names.items())).distinct()


def centred(members: DataFrame, turn: Column) -> DataFrame:
    """Members of the buckets that hold several components, each row with its bucket's centre: the least turn."""
    own = F.struct("node", "key", "n_shingles", "component")
    chosen = (
        members.groupBy("bucket")
        .agg(F.min(F.struct(turn.alias("turn"), own.alias("c"))).alias("best"), F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi")
        .select("bucket", F.col("best.c").alias("centre"))
    )
    return members.join(chosen, "bucket")


SHINGLES = "node bigint, n_shingles bigint, component bigint, shingle bigint"


def shingle_rows(nodes: DataFrame, text: DataFrame) -> DataFrame:
    """One row per shingle of each node (node, n_shingles, key, component)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SHINGLES.split(", ")]
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for lo, hi, buf, offsets in K.chunks(batch.column("text")):
                sets = shingle_sets(buf, offsets)
                # the id may be repeated with another text
                sets = [s if len(s) and set_key(s) == key else s[:0] for s, key in zip(sets, keys[lo:hi], strict=True)]
                rows = pa.array(np.repeat(np.arange(lo, hi), [len(s) for s in sets]))
                columns = [batch.column(c).take(rows) for c in names[:3]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(K.signed(np.concatenate(sets)))], names=names)

    joined = nodes.join(text.withColumnRenamed("doc_id", "node"), "node")
    return joined.select("node", "n_shingles", "component", "key", "text").mapInArrow(work, SHINGLES)


def prefixes(nodes: DataFrame, text: DataFrame) -> DataFrame:
    """Rows (shingle, node, n_shingles, component, place): each node's first shingles, rarest first.

    Two sets that reach the similarity have their first common shingle among these.  Shingles of one
    node only come first of all and take up places, but no rows.
    """
    rows = shingle_rows(nodes, text)
    common = cut(rows.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1"))
    listed = (
        rows.join(common, "shingle")
        .groupBy("node", "n_shingles", "component")
        .agg(F.sort_array(F.collect_set(F.struct("times", "shingle"))).alias("ranked"))
    )
    alone = F.col("n_shingles") - F.size("ranked")
    least = F.ceil(SIMILARITY_PCT * F.col("n_shingles") / 100)
    first = listed.withColumns({"alone": alone, "length": F.col("n_shingles") - least + 1 - alone}).where("length > 0")
    placed = first.select("node", "n_shingles", "component", "alone", F.posexplode(F.slice("ranked", F.lit(1), F.col("length").cast("int"))))
    return placed.select("col.shingle", "node", "n_shingles", "component", (F.col("alone") + F.col("pos") + 1).alias("place"))


def prefix_pairs(members: DataFrame, text: DataFrame) -> DataFrame:
    """Pairs (a, a_key, b, b_key) of members of different components; all that are similar enough are among them."""
    nodes = cut(members.select("node", "n_shingles", "key", "component").distinct())
    rows = cut(prefixes(nodes, text))
    x, y = rows.alias("x"), rows.alias("y")
    shorter = (F.col("y.n_shingles") < F.col("x.n_shingles")) | (
        (F.col("y.n_shingles") == F.col("x.n_shingles")) & (F.col("y.node") < F.col("x.node"))
    )
    # the shingle at hand and those behind it in both orders must suffice for the overlap that the sizes ask for
    behind = F.least(F.col("x.n_shingles") - F.col("x.place"), F.col("y.n_shingles") - F.col("y.place")) + 1
    both = F.col("x.n_shingles") + F.col("y.n_shingles")
    fits = (100 * F.col("y.n_shingles") >= SIMILARITY_PCT * F.col("x.n_shingles")) & ((100 + SIMILARITY_PCT) * behind >= SIMILARITY_PCT * both)
    met = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.component") != F.col("y.component")) & shorter & fits)
    pairs = met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    keys = nodes.select("node", "key")
    pairs = pairs.join(keys.withColumnsRenamed({"node": "a", "key": "a_key"}), "a")
    return pairs.join(keys.withColumnsRenamed({"node": "b", "key": "b_key"}), "b").select("a", "a_key", "b", "b_key")


def near_links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (u, v) between nodes (node, n_shingles, key, bands)."""
    buckets = nodes.where("node is not null").select(
        F.explode("bands").alias("bucket"), "node", "n_shingles", "key", F.col("node").alias("component")
    )
    members = cut(centred(buckets, F.col("node")))
    needed = members.select(F.col("node").alias("doc_id")).distinct()
    text = docs.where("text is not null").select(F.col("doc_id").cast("bigint"), "text")
    text = cut(text.join(needed, "doc_id", "left_semi"))
    tried, links, turn = None, None, 1
    while True:
        pairs = stars(members)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        new = cut(confirmed(pairs, text))
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        links = new if links is None else links.union(new)
        # a centre has met all members of its bucket and leaves it
        rest = members.where("node <> centre.node").drop("centre", "component").join(components(links), "node", "left")
        order = F.xxhash64("bucket", "node", F.lit(turn))
        members = cut(centred(rest.withColumn("component", F.coalesce("component", "node")), order))
        if members.isEmpty():
            return links
        if turn >= LEAST_ROUNDS and PAIRS_A_LINK * new.count() < pairs.count():
            pairs = cut(prefix_pairs(members, text).join(tried, ["a", "b"], "left_anti"))
            return links.union(cut(confirmed(pairs, text)))
        turn += 1


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row (doc_id, n_shingles, component_id, kept) per document.

    Two documents are linked if their shingle sets have a similarity of at least 0.75; component_id
    is the smallest doc_id reachable through links, and the document that has it is kept.  A null,
    empty or blank text has no shingles, is linked with nothing and kept.  Repeated rows are copies
    of each other: all of them carry the same component_id.  A document without an id is linked by
    its set only and is kept if no document with an id has the same set.  Other columns are ignored.
    """
    signed = cut(signatures(docs))
    nodes = (
        signed.where("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    nodes = cut(nodes)
    labels = components(near_links(nodes, docs))
    of_key = nodes.join(labels, "node", "left").select("key", F.coalesce("component", "node").alias("component_id"))
    found = signed.join(of_key, "key", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents without those that ``near_duplicates`` doesn't keep; columns as they came.

    Repeated rows of a kept document are reduced to one; documents without an id all stay.
    """
    kept = near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    once = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.select(docs.columns).unionByName(docs.where("doc_id is null"))
