"""Jaccard join of documents on word n-grams by a grouped prefix join.

Shingles have one order for all documents, the frequent ones last.  Two sets that reach the similarity
have a shingle in common among the first ``n - ceil(t n) + 1`` of each (prefix filter).  Documents with
one set are one node; nodes with the same prefix and size are one group, and only groups stand in the
lists of a prefix shingle.  A pair of groups must fit by size and by what is left behind the common
shingle (positional filter).  Then it is expanded to the nodes of both groups, and these are verified on
the full sets of their texts.

The order is a function of the shingle alone: a fixed eighth of all shingles (by hash) is counted, and
those of them that very many documents have go last, at most ``MOST_FREQUENT``.  It decides how long
lists become, never which links are found.

Only components are wanted, so a list of near copies needs no pair of each two.  First stars are drawn:
each list's centre meets the others, in turns that go on as long as they find links.  What then still
joins several components is finished exactly: lists are parted by size class, short ones are joined group
by group, and the nodes of long ones go through a second grouped prefix join, in the order of their real
document frequencies.  Before any text is fetched, a pair of groups must also fit by all that their
prefixes have in common (``fitting``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm import kernel as K
from haulgrain.llm.minhash import set_key, shingle_sets
from haulgrain.llm.shared import components, cut

SHINGLE = 3
SIMILARITY_PCT = 90

#: shingles with a hash below are counted: an eighth
COUNTED = np.uint64(1 << 61)
#: a counted shingle is frequent if more documents have it; doubled until at most MOST_FREQUENT are (8 MB)
FREQUENT = 32
MOST_FREQUENT = 1 << 20
#: lists of at most so many groups of one size class and its neighbour are joined pair by pair
SHORT_LIST = 256
LEAST_TURNS = 2
#: turns go on while at least one in so many pairs is a link
PAIRS_A_LINK = 10
#: documents that meet one centre in one task
SHARE = 256
#: bits of the fixed-size map of documents whose text is needed: 4 MB
SLOT_BITS = 25


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for lo, hi, buf, offsets in K.chunks(column):
        yield lo, hi, shingle_sets(buf, offsets, k)


def frequent_shingles(texts: DataFrame, k: int) -> np.ndarray:
    """Sorted hashes of the counted shingles that more than ``FREQUENT`` documents have, at most ``MOST_FREQUENT``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets in _sets(batch.column("text"), k):
                counted = [s[: np.searchsorted(s, COUNTED)] for s in sets]
                one, times = np.unique(np.concatenate(counted), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(one)), pa.array(times)], names=["shingle", "times"])

    counts = texts.select("text").mapInArrow(work, "shingle bigint, times bigint").groupBy("shingle").agg(F.sum("times").alias("times"))
    counts, limit = cut(counts.where(F.col("times") > FREQUENT)), FREQUENT
    while counts.where(F.col("times") > limit).count() > MOST_FREQUENT:
        limit *= 2
    rows = counts.where(F.col("times") > limit).select("shingle").toArrow().column(0).to_numpy()
    return np.sort(rows.view(np.uint64))


SIGNED = "doc_id bigint, n_shingles bigint, key binary, prefix array<bigint>, prefix_key binary"


def signatures(docs: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """Set size, 128-bit key of the set and ordered prefix of each document; without words key and prefix are null."""

    def prefix_of(values: np.ndarray) -> np.ndarray:
        order = (values >= COUNTED).astype(np.int8)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
            order[frequent[at] == values] = 2
        ranked = values[np.lexsort((values, order))]
        return ranked[: len(values) - least_overlap(len(values), percent) + 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in _sets(batch.column("text"), k):
                prefixes = [K.signed(prefix_of(s)) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())),
                        pa.array([None if p is None else hashlib.blake2b(p.tobytes(), digest_size=16).digest() for p in prefixes], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "key", "prefix", "prefix_key"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, SIGNED)


def texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents in ``needed`` (node).

    A bit map of fixed size lets go of most other texts before any text is shuffled.
    """
    slot = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - SLOT_BITS) + 1  # noqa: E731  bitmaps count from 1
    rows = needed.groupBy(F.bitmap_bucket_number(slot(F.col("node"))).alias("n"))
    bits = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for n, part in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot(F.col("node")))).alias("bits")).collect():
        bits[(n - 1) * 4096 : n * 4096] = np.frombuffer(part, np.uint8)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("slot")) - 1
            yield batch.select(["doc_id", "text"]).filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1))

    rows = docs.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("bigint"), "text")
    kept = rows.withColumn("slot", slot(F.col("doc_id"))).mapInArrow(work, "doc_id bigint, text string")
    return kept.join(needed.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")


def verified(pairs: DataFrame, text: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, a_key, b, b_key) whose full sets reach the similarity, as links (u, v).

    The partners of each ``a`` are dealt into shares of about ``SHARE``.  A share is one run of rows:
    the text of ``a`` first, then the texts of its partners, so a task holds one set beside a batch.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, None
        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("a", "share", "kind", "b", "key")), strict=True))
            found = []
            for lo, hi, sets in _sets(batch.column("text"), k):
                for (a, share, kind, b, key), one in zip(names[lo:hi], sets, strict=True):
                    if (a, share) != now:
                        now, mine = (a, share), None
                    if not len(one) or set_key(one) != key:
                        continue  # another text of a repeated id
                    if kind == 0:
                        mine = one
                    elif mine is not None:
                        both = len(np.intersect1d(mine, one, assume_unique=True))
                        if 100 * both >= percent * (len(mine) + len(one) - both):
                            found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["u", "v"])

    shares = pairs.groupBy("a", "a_key").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"))
    first = shares.select("a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("kind"), F.col("a").alias("b"), F.col("a_key").alias("key"))
    rest = pairs.join(shares.drop("a_key"), "a").select("a", F.pmod(F.xxhash64("b"), "shares").cast("int").alias("share"), F.lit(1).alias("kind"), "b", F.col("b_key").alias("key"))
    rows = first.unionByName(rest).join(text.withColumnRenamed("doc_id", "b"), "b")
    dealt = rows.repartition("a", "share").sortWithinPartitions("a", "share", "kind")
    return dealt.mapInArrow(work, "u bigint, v bigint").distinct()


def _fits(x: str, y: str, percent: int) -> Column:
    """Size and positional filter for two list rows with n_shingles and place."""
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    behind = F.least(n - F.col(f"{x}.place"), m - F.col(f"{y}.place")) + 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * behind >= percent * (n + m))


def grouped(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (grp, node, n_shingles, key, component) and heads (grp, n_shingles, alone, prefix) of nodes.

    ``nodes`` has node, n_shingles, key, component, prefix, prefix_key and alone: how many shingles, of
    this node only, stand before the prefix.
    """
    heads = nodes.groupBy("n_shingles", "prefix_key", "alone").agg(F.min("node").alias("grp"), F.first("prefix").alias("prefix"))
    named = heads.select("n_shingles", "prefix_key", "alone", "grp")
    members = nodes.drop("prefix").join(named, ["n_shingles", "prefix_key", "alone"])
    return members.select("grp", "node", "n_shingles", "key", "component"), heads.select("grp", "n_shingles", "alone", "prefix")


def lists_of(heads: DataFrame) -> DataFrame:
    """One row (shingle, grp, n_shingles, place) per shingle of a prefix; places count from 1."""
    rows = heads.select("grp", "n_shingles", "alone", F.posexplode("prefix").alias("at", "shingle"))
    return rows.select("shingle", "grp", "n_shingles", (F.col("alone") + F.col("at") + 1).alias("place"))


def fitting(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Those pairs of groups (g, h) whose sets can be similar enough by their whole prefixes; g = h always can.

    Behind the last shingle that both prefixes have, at most what is left of the shorter rest can be
    common to both.
    """
    x = heads.select(F.col("grp").alias("g"), F.struct("n_shingles", "alone", "prefix").alias("x"))
    y = heads.select(F.col("grp").alias("h"), F.struct("n_shingles", "alone", "prefix").alias("y"))
    both = F.array_intersect("x.prefix", "y.prefix")
    met = pairs.join(x, "g").join(y, "h").withColumn("both", both).withColumn("last", F.element_at("both", -1))
    left = [F.col(f"{s}.n_shingles") - F.col(f"{s}.alone") - F.array_position(F.col(f"{s}.prefix"), F.col("last")) for s in "xy"]
    enough = (100 + percent) * (F.size("both") + F.least(*left)) >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles"))
    return met.where((F.col("g") == F.col("h")) | ((F.size("both") > 0) & enough)).select("g", "h")


def shared_lists(lists: DataFrame) -> DataFrame:
    """The rows of lists that have several groups, and their number ``f``; both sides of the join read one exchange."""
    dealt = lists.repartition("shingle")
    return dealt.join(dealt.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1"), "shingle")


def _named(pairs: DataFrame) -> DataFrame:
    """(a, a_key, b, b_key) from structs x and y of (node, n_shingles, key), the smaller node first."""
    swap = F.col("y.node") < F.col("x.node")
    both = pairs.select(F.when(swap, F.col("y")).otherwise(F.col("x")).alias("x"), F.when(swap, F.col("x")).otherwise(F.col("y")).alias("y"))
    return both.select(F.col("x.node").alias("a"), F.col("x.key").alias("a_key"), F.col("y.node").alias("b"), F.col("y.key").alias("b_key")).distinct()


def expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs of groups (g, h) as pairs of their nodes in different components; g = h gives the pairs inside a group."""
    node = F.struct("node", "n_shingles", "key")
    x = members.select(F.col("grp").alias("g"), node.alias("x"), F.col("component").alias("x_component"))
    y = members.select(F.col("grp").alias("h"), node.alias("y"), F.col("component").alias("y_component"))
    met = pairs.join(x, "g").join(y, "h").where("x_component <> y_component and (g <> h or x.node < y.node)")
    return _named(met)


def star_pairs(lists: DataFrame, members: DataFrame, heads: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of the first node of each list's centre with the nodes of the list's other groups; also inside groups."""
    order = F.col("grp") if turn == 1 else F.xxhash64("shingle", "grp", F.lit(turn))
    centre = lists.groupBy("shingle").agg(F.min(F.struct(order.alias("turn"), "grp", "n_shingles", "place")).alias("c"))
    met = lists.join(centre, "shingle").withColumn("x", F.struct("grp", "n_shingles", "place"))
    met = met.where((F.col("grp") != F.col("c.grp")) & _fits("x", "c", percent))
    groups = fitting(met.select(F.col("c.grp").alias("g"), F.col("grp").alias("h")).distinct(), heads, percent)
    first = members.where("node = grp").select(F.col("grp").alias("g"), F.struct("node", "n_shingles", "key").alias("x"), F.col("component").alias("c"))
    others = members.select(F.col("grp").alias("h"), F.struct("node", "n_shingles", "key").alias("y"), "component")
    if turn == 1:
        groups = groups.union(members.where("node <> grp").select("grp", "grp").distinct())
    return _named(groups.join(first, "g").join(others, "h").where("c <> component"))


def classed(lists: DataFrame, percent: int) -> DataFrame:
    """Open lists parted by size: (shingle, size_class, ...) with the number ``f`` of groups in each part.

    A group stands in the part of its own class and in the next one, so two groups that fit by size meet
    in the part of the larger one's class.  Parts with one component are left out.
    """
    width = math.log(100 / percent) * 1.01 if percent < 100 else 1e-9
    own = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(width))
    rows = lists.drop("f").withColumn("own", own).withColumn("size_class", F.explode(F.array("own", F.col("own") + 1)))
    parts = rows.groupBy("shingle", "size_class").agg(
        F.count("*").alias("f"), F.min("lo").alias("least"), F.max("hi").alias("most"), F.max("own").alias("largest")
    )
    open_ = parts.where("least < most and largest = size_class").select("shingle", "size_class", "f")
    return rows.join(open_, ["shingle", "size_class"])


def list_pairs(parts: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of groups (g, h), g < h, that stand in one part of a list, fit and aren't one component."""
    x, y = parts.alias("x"), parts.alias("y")
    same = (F.col("x.lo") == F.col("y.hi")) & (F.col("x.hi") == F.col("y.lo"))
    here = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.size_class") == F.col("y.size_class"))
    once = F.greatest("x.own", "y.own") == F.col("x.size_class")
    met = x.join(y, here & (F.col("x.grp") < F.col("y.grp")) & once & _fits("x", "y", percent) & ~same)
    return met.select(F.col("x.grp").alias("g"), F.col("y.grp").alias("h")).distinct()


def _with_components(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Lists that hold several components, with the lowest and highest component of each group."""
    of_group = members.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    rows = lists.drop("f", "lo", "hi").join(of_group, "grp")
    open_ = rows.groupBy("shingle").agg(F.count("*").alias("f"), F.min("lo").alias("least"), F.max("hi").alias("most")).where("least < most")
    return rows.join(open_.select("shingle", "f"), "shingle")


SHINGLES = "node bigint, shingle bigint"


def by_frequency(members: DataFrame, text: DataFrame, k: int, percent: int) -> DataFrame:
    """The nodes of ``members`` with prefixes in the order of document frequency among them, rarest first.

    Shingles of one node only meet nothing: they take up places, but stand in no list.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_pylist()
            for lo, hi, sets in _sets(batch.column("text"), k):
                sets = [s if len(s) and set_key(s) == key else s[:0] for s, key in zip(sets, keys[lo:hi], strict=True)]
                rows = pa.array(np.repeat(np.arange(lo, hi), [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([batch.column("node").take(rows), pa.array(K.signed(np.concatenate(sets)))], names=["node", "shingle"])

    joined = members.select("node", "key").join(text.withColumnRenamed("doc_id", "node"), "node").select("node", "key", "text")
    dealt = joined.mapInArrow(work, SHINGLES).repartition("shingle")
    common = dealt.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    ranked = dealt.join(common, "shingle").groupBy("node").agg(F.sort_array(F.collect_set(F.struct("times", "shingle"))).alias("ranked"))
    first = members.join(ranked, "node").withColumn("alone", F.col("n_shingles") - F.size("ranked"))
    length = F.col("n_shingles") - F.ceil(F.lit(percent) * F.col("n_shingles") / 100) + 1 - F.col("alone")
    first = first.withColumn("length", length.cast("int")).where("length > 0")
    first = first.withColumn("prefix", F.expr("transform(slice(ranked, 1, length), x -> x.shingle)"))
    first = first.withColumn("prefix_key", F.sha2(F.concat_ws(",", F.expr("transform(prefix, x -> string(x))")), 256))
    return first.select("node", "n_shingles", "key", "component", "prefix", "prefix_key", "alone")


def exact_pairs(members: DataFrame, text: DataFrame, k: int, percent: int) -> DataFrame:
    """All pairs of nodes in different components that can be similar enough, by a join in the order of real frequencies."""
    groups, heads = (cut(x) for x in grouped(cut(by_frequency(members, text, k, percent))))
    parts = cut(classed(_with_components(shared_lists(lists_of(heads)), groups), percent))
    return expanded(fitting(list_pairs(parts, percent).union(_mixed(groups)), heads, percent), groups)


def _mixed(members: DataFrame) -> DataFrame:
    """Groups that hold several components, as pairs with themselves."""
    several = members.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return several.select(F.col("grp").alias("g"), F.col("grp").alias("h"))


def similar_links(nodes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) between nodes (node, n_shingles, key, prefix, prefix_key): all that components need."""
    members, heads = (cut(x) for x in grouped(nodes.withColumns({"component": F.col("node"), "alone": F.lit(0)})))
    lists = cut(shared_lists(lists_of(heads)))
    met = cut(lists.select("grp").union(members.where("node <> grp").select("grp")).distinct())
    members, heads = cut(members.join(met, "grp", "left_semi")), cut(heads.join(met, "grp", "left_semi"))
    tried, links, turn = None, None, 1

    def confirm(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        nonlocal tried, links
        pairs = cut(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        # the texts of these pairs only: keeping those of all nodes in lists would be most of the corpus
        text = texts_of(docs, pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
        new = cut(verified(pairs, text, k, percent))
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        links = new if links is None else links.union(new)
        return pairs, new

    while True:
        pairs, new = confirm(star_pairs(lists, members, heads, turn, percent))
        labels = components(links)
        members = members.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        members = cut(members.select("grp", "node", "n_shingles", "key", "component"))
        lists = cut(_with_components(lists, members))
        if turn >= LEAST_TURNS and PAIRS_A_LINK * new.count() < pairs.count():
            break
        if lists.isEmpty():
            break
        turn += 1
    parts = cut(classed(lists, percent))
    short = list_pairs(parts.where(F.col("f") <= SHORT_LIST), percent).union(_mixed(members))
    confirm(expanded(fitting(short, heads, percent), members))
    long = parts.where(F.col("f") > SHORT_LIST).select("grp").distinct()
    rest = cut(members.join(long, "grp", "left_semi"))
    if not rest.isEmpty():
        confirm(exact_pairs(rest.drop("grp"), texts_of(docs, rest.select("node")), k, percent))
    return links


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = SIMILARITY_PCT) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) per document.

    Two documents are linked if their sets of ``k`` words are at least ``percent`` per cent alike;
    component_id is the smallest doc_id reachable through links, the document's own included.  A null,
    empty or blank text has no shingles and is linked with nothing.  A text of fewer than k words has
    one shingle.  Repeated rows are copies of each other, and each has its row.  A document without an
    id is linked by its set only.  An empty table gives an empty result; other columns are ignored.
    """
    frequent = frequent_shingles(docs.where("text is not null"), k)
    signed = cut(signatures(docs, frequent, k, percent))
    firsts = [F.first(c).alias(c) for c in ("n_shingles", "prefix", "prefix_key")]
    nodes = cut(signed.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("node"), *firsts))
    # a smaller set is linked with nothing but itself
    able = nodes.where("node is not null").where(100 * F.col("n_shingles") >= percent * (F.col("n_shingles") + 1))
    labels = components(similar_links(able, docs, k, percent))
    of_key = nodes.join(labels, "node", "left").select("key", F.coalesce("component", "node").alias("component_id"))
    found = signed.select("doc_id", "n_shingles", "key").join(of_key, "key", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
