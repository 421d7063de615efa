"""Phrase collocations from sorted suffix pointers.

A phrase is a run of words inside one piece of a text.  A pointer stands at each word; its suffix is
the run of words that starts there, cut at ``longest`` words, at the end of its piece and at the first
word that is too rare to stand in any phrase wanted.  Two passes over the texts:

1. Words are counted per language, which gives the leading-word counts for all data at once.  Words
   are known by 64-bit hashes of language and word from then on; the pass checks that no two of
   them share a hash, else it is repeated with other hashes.
2. The suffixes of each chunk of texts are sorted, equal ones become one with a weight, and all go to
   the bucket of their leading word pair.  Each bucket is sorted by multikey three-way quicksort
   (``frequent_runs``): the suffixes that equal the pivot word at every depth are one partition, the
   weight of that partition is the count of the phrase, and a partition below ``least`` is abandoned.

A pair of two very frequent words may hold a large share of all suffixes, so its suffixes are dealt
out by their third word too and the pair itself is counted apart.  Any other pair holds at most one
suffix in ``SHARE``.  A bucket keeps distinct suffixes only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulgrain.llm import kernel as K
from haulgrain.llm.shared import cut

LONGEST = 3
LEAST = 10
CONTAINED_PCT = 50
TOP = 2000
NO_LANG = "und"

#: a word is very frequent if it makes up at least one in so many of all words, so there are at most so many
SHARE = 1024
#: words a bucket is meant for
BUCKET_WORDS = 1 << 20
#: suffixes a bucket gathers before equal ones are merged
GATHERED = 1 << 21
#: bits of the fixed-size map of words that are frequent enough: 2^25 bits are 4 MB
SLOT_BITS = 25
#: texts whose words, and whose suffixes, are counted together
WORD_CHUNK = 1 << 22
SUFFIX_CHUNK = 1 << 22
_LONG_WORD = 256

_BREAK = K.byte_table(lambda b: b in b".,;:!?\n\x0b\x0c\r")
_WORD = K.byte_table(lambda b: b not in b" \t" and b not in b".,;:!?\n\x0b\x0c\r")
_NEXT = np.uint64(0xC2B2AE3D27D4EB4F)


def lang_hash(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")


def words_of(buf: np.ndarray, offsets: np.ndarray, langs: list[str], seed: int):
    """(lower-cased bytes, starts, ends, owners, hashes, linked) of the words of a chunk.

    ``linked`` says that the next word belongs to the same piece of the same text.
    """
    buf = K.LOWER[buf]
    starts, ends, first = K.spans(_WORD[buf], offsets)
    owner = K.owners(first)
    shuffled = np.random.default_rng(seed).permutation(256).astype(np.uint8)[buf] if seed else buf
    hashes = K.span_hash(K.prefix_hash(shuffled), starts, ends)
    for i in np.flatnonzero(ends - starts >= _LONG_WORD):
        hashes[i] = lang_hash(buf[starts[i] : ends[i]].tobytes().decode(), seed)
    names = {name: lang_hash(name, seed) for name in set(langs)}
    of_text = np.array([names[name] for name in langs], np.uint64)
    hashes = K.mix(hashes + of_text[owner]) if len(hashes) else hashes
    hashes[hashes == 0] = 1  # 0 ends a suffix
    breaks = np.cumsum(_BREAK[buf])[starts] if len(starts) else starts
    linked = np.zeros(len(starts), bool)
    linked[:-1] = (owner[1:] == owner[:-1]) & (breaks[1:] == breaks[:-1])
    return buf, starts, ends, owner, hashes, linked


def suffixes(hashes: np.ndarray, linked: np.ndarray, longest: int) -> list[np.ndarray]:
    """Column j holds the j-th word of the suffix at each pointer, 0 behind its end; a word of 0 ends a suffix."""
    n = len(hashes)
    going, columns = hashes != 0, [hashes]
    for j in range(1, longest):
        follows = np.zeros(n, bool)
        if n > j:
            follows[: n - j] = linked[j - 1 : n - 1] & (hashes[j:] != 0)
        going = going & follows
        column = np.zeros(n, np.uint64)
        if n > j:
            column[: n - j][going[: n - j]] = hashes[j:][going[: n - j]]
        columns.append(column)
    return columns


def merged(columns: list[np.ndarray], weights: np.ndarray, key: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Equal suffixes that ``key`` brings side by side as one, in the order of ``key``, with their weights added up."""
    order = np.argsort(key)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    if len(at):
        weights = np.add.reduceat(weights[order], at)
    return [c[at] for c in columns], weights, key[order][at]


def frequent_runs(columns: list[np.ndarray], weights: np.ndarray, least: int, known: int = 0) -> list[list[np.ndarray]]:
    """Multikey three-way quicksort of weighted suffixes, all partitions of a round at once.

    Returns for each depth the words (one array per depth) and the count of every phrase that
    reaches ``least``, shorter ones than ``known`` words left out.  Each round deals every open
    partition into suffixes below, equal to and above its pivot word at the depth of the
    partition.  The equal ones go on one word deeper, and their weight is the count of their common
    prefix.  Partitions that weigh less than ``least`` are dropped.
    """
    found: list[list[np.ndarray]] = [[] for _ in columns]
    row = np.arange(len(weights))
    sizes, depth = np.array([len(row)]), np.zeros(1, np.int64)
    while len(row):
        first = np.cumsum(sizes) - sizes
        part = np.repeat(np.arange(len(sizes)), sizes)
        deep = depth[part]
        word = columns[0][row]
        for j in range(1, len(columns)):
            here = np.flatnonzero(deep == j)
            word[here] = columns[j][row[here]]
        pivot = word[first + sizes // 2]
        of_row = pivot[part]
        side = (word > of_row).astype(np.int64) * 2 + (word == of_row)
        place = part * 3 + side
        count = np.bincount(place, minlength=3 * len(sizes))
        weight = np.bincount(place, weights=weights[row], minlength=3 * len(sizes)).astype(np.int64)
        # stable deal: place of a row inside its side, behind the sides before it
        begin = np.cumsum(count) - count
        inside = np.empty(len(row), np.int64)
        for s in range(3):
            of_side = side == s
            ran = np.cumsum(of_side)
            before = (ran - of_side)[first]
            inside[of_side] = (ran - before[part])[of_side] - 1
        dealt = np.empty_like(row)
        dealt[begin[place] + inside] = row
        equal = np.arange(1, 3 * len(sizes), 3)
        counted = equal[(weight[equal] >= least) & (pivot != 0)]
        for j in range(len(columns)):
            mine = counted[depth[counted // 3] == j]
            if j + 1 >= known and len(mine):
                leader = dealt[begin[mine]]
                found[j].append([*(columns[i][leader] for i in range(j + 1)), weight[mine]])
        depth = np.repeat(depth, 3)
        depth[equal] += 1
        stays = (weight >= least) & (count > 0)
        stays[equal] &= (pivot != 0) & (depth[equal] < len(columns))
        keep = np.repeat(stays, count)
        row, sizes, depth = dealt[keep], count[stays], depth[stays]
    return [[np.concatenate(x) for x in zip(*f, strict=True)] if f else [] for f in found]


def _langs(batch: pa.RecordBatch) -> list[str]:
    return [NO_LANG if x is None else x for x in batch.column("lang").to_pylist()]


def _word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """Rows (word_hash, lang, word, times) per language, word and chunk of texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _langs(batch)
            for lo, hi, buf, offsets in K.chunks(batch.column("text"), WORD_CHUNK):
                buf, starts, ends, owner, hashes, _ = words_of(buf, offsets, langs[lo:hi], seed)
                one, at, times = np.unique(hashes, return_index=True, return_counts=True)
                data = buf.tobytes()
                words = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(K.signed(one)),
                        pa.array(np.array(langs[lo:hi], object)[owner[at]], pa.string()),
                        pa.array(words, pa.binary()).cast(pa.string()),
                        pa.array(times),
                    ],
                    names=["word_hash", "lang", "word", "times"],
                )

    return texts.mapInArrow(work, "word_hash bigint, lang string, word string, times bigint")


def word_table(texts: DataFrame) -> tuple[DataFrame, int]:
    """(word_hash, lang, word, f) of all words, one hash each, and the seed that gave these hashes.

    ``texts`` has lang and text.  Two words of one chunk that share a hash would be counted as one
    there, so a clash can go unseen only where it always falls into one chunk: 64 bits make that a
    matter of 1e-9 for a chunk of 4 MB.
    """
    for seed in range(8):
        words = cut(_word_counts(texts, seed).groupBy("word_hash", "lang", "word").agg(F.sum("times").alias("f")))
        if words.groupBy("word_hash").count().where("count > 1").isEmpty():
            return words, seed
    raise ValueError("words that share a hash under every seed")


def _slots(frequent: DataFrame) -> np.ndarray:
    """Fixed-size bit map of the frequent words: 2^SLOT_BITS bits, whatever the vocabulary."""
    slot = F.shiftrightunsigned("word_hash", 64 - SLOT_BITS) + 1  # Spark's bitmaps count from 1
    rows = frequent.groupBy(F.bitmap_bucket_number(slot).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    bits = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for n, part in rows.collect():
        bits[(n - 1) * 4096 : n * 4096] = np.frombuffer(part, np.uint8)
    return bits


SUFFIX_ROWS = "bucket bigint, words binary, codes binary, weights binary"


def _routed(texts: DataFrame, seed: int, slots: np.ndarray, hot: np.ndarray, buckets: int, longest: int) -> DataFrame:
    """The distinct suffixes of each chunk, packed per bucket of their leading words."""

    def key_of(columns: list[np.ndarray]) -> np.ndarray:
        lead = K.mix(columns[0] * _NEXT + columns[1])
        if longest > 2 and len(hot):
            split = np.isin(columns[0], hot) & np.isin(columns[1], hot) & (columns[2] != 0)
            lead = np.where(split, K.mix(lead * _NEXT + columns[2]), lead)
        tail = lead
        for column in columns[2:]:
            tail = K.mix(tail * _NEXT + column)
        return (lead & np.uint64(0xFFFFFFFF00000000)) | (tail >> np.uint64(32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = _langs(batch)
            for lo, hi, buf, offsets in K.chunks(batch.column("text"), SUFFIX_CHUNK):
                *_, hashes, linked = words_of(buf, offsets, langs[lo:hi], seed)
                slot = hashes >> np.uint64(64 - SLOT_BITS)
                frequent = (slots[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1
                hashes[frequent == 0] = 0
                columns = suffixes(hashes, linked, longest)
                at = np.flatnonzero(columns[1])
                if not len(at):
                    continue
                columns = [c[at] for c in columns]
                if longest > 2 and len(hot):  # pairs of hot words are counted apart from their suffixes
                    pairs = np.flatnonzero(np.isin(columns[0], hot) & np.isin(columns[1], hot) & (columns[2] != 0))
                    none = np.zeros(len(pairs), np.uint64)
                    columns = [np.concatenate([c, c[pairs] if j < 2 else none]) for j, c in enumerate(columns)]
                columns, weights, key = merged(columns, np.ones(len(columns[0]), np.int64), key_of(columns))
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                rows = []
                for a, b in zip(edge, np.append(edge[1:], len(bucket)), strict=True):
                    words, codes = np.unique(np.concatenate([c[a:b] for c in columns]), return_inverse=True)
                    wide = np.uint16 if len(words) <= 1 << 16 else np.uint32
                    codes = codes.reshape(longest, -1)
                    order = np.argsort(codes[0] * len(words) + codes[1])  # equal words side by side take less room
                    rows.append((int(bucket[a]), words.tobytes(), codes[:, order].astype(wide).tobytes(), weights[a:b][order].astype(np.uint32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                    names=["bucket", "words", "codes", "weights"],
                )

    return texts.mapInArrow(work, SUFFIX_ROWS)


def _counted(routed: DataFrame, hot: np.ndarray, longest: int, least: int) -> DataFrame:
    """Counts (words, f) of the frequent runs of two words and more, from rows sorted by bucket."""

    def unpack(words: bytes, codes: bytes, weights: bytes) -> tuple[list[np.ndarray], np.ndarray]:
        dictionary, weight = np.frombuffer(words, np.uint64), np.frombuffer(weights, np.uint32).astype(np.int64)
        code = np.frombuffer(codes, np.uint16 if len(dictionary) <= 1 << 16 else np.uint32).reshape(longest, -1)
        return [dictionary[c] for c in code], weight

    def together(parts: list) -> list:
        columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)]
        key = columns[0]
        for column in columns[1:]:
            key = K.mix(key * _NEXT + column)
        columns, weights, _ = merged(columns, np.concatenate([p[1] for p in parts]), key)
        return [(columns, weights)]

    def results(parts: list) -> Iterator[pa.RecordBatch]:
        ((columns, weights),) = together(parts)
        split = np.zeros(len(weights), bool)
        if longest > 2 and len(hot):
            split = np.isin(columns[0], hot) & np.isin(columns[1], hot) & (columns[2] != 0)
        for mask, known in ((~split, 2), (split, 3)):
            for length, found in enumerate(frequent_runs([c[mask] for c in columns], weights[mask], least, known), 1):
                if length < known or not found:
                    continue
                values = np.stack(found[:-1], axis=1).reshape(-1).view(np.int64)
                offsets = pa.array(np.arange(0, len(values) + 1, length), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(values)), pa.array(found[-1])], names=["words", "f"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, gathered = None, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("bucket", "words", "codes", "weights")]
            for i in range(batch.num_rows):
                bucket, *packed = (c[i].as_py() for c in columns)
                if bucket != now and parts:
                    yield from results(parts)
                    parts, gathered = [], 0
                now = bucket
                parts.append(unpack(*packed))
                gathered += len(parts[-1][1])
                if gathered > GATHERED:
                    parts = together(parts)
                    gathered = len(parts[0][1]) // 2  # at least as many again before the next merge
        if parts:
            yield from results(parts)

    dealt = routed.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(work, "words array<bigint>, f bigint")


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (word_hash, lang, word, f) that occur ``least`` times, n per lang, counts (words, f) of frequent phrases.

    ``words`` of a count is the array of word hashes; single words are among the counts.
    """
    if longest < 2:
        raise ValueError("a phrase has at least two words")
    texts = docs.where("text is not null").select("lang", "text")
    words, seed = word_table(texts)
    frequent = words.where(F.col("f") >= least)
    per_lang = words.groupBy("lang").agg(F.sum("f").alias("n"))
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    hot = [r[0] for r in frequent.where(F.col("f") * SHARE >= total).select("word_hash").collect()]
    hot = np.sort(np.array(hot, np.int64).view(np.uint64))
    buckets = max(16, total // BUCKET_WORDS + 1)
    routed = _routed(texts, seed, _slots(frequent), hot, buckets, longest)
    runs = _counted(routed, hot, longest, least).groupBy("words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    singles = frequent.select(F.array("word_hash").alias("words"), "f")
    return frequent, per_lang, cut(runs.unionByName(singles))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, contained_pct: int = CONTAINED_PCT, top: int = TOP) -> DataFrame:
    """The ``top`` collocations per language: (lang, rank, phrase, a, l, r, n, score).

    Candidates are phrases of 2 to ``longest`` words with a count ``a`` of at least ``least``.  The
    score is floor(1000000 a a / (l r)) for the cut into two parts, with counts l and r, that scores
    lowest; of equal cuts the shorter first part counts.  A candidate is dropped if a longer one,
    dropped or not, contains its words and has at least ``contained_pct`` per cent of its count.  The
    rank goes by score, a (both descending) and phrase.

    A-Z count as a-z.  A null lang counts as ``und``.  Null, empty and blank texts have no words; an
    empty table gives an empty result.  Repeated rows count each.  Other columns are ignored, and
    doc_id isn't looked at.  Counts are exact below 10^15.
    """
    frequent, per_lang, counts = phrase_counts(docs, longest, least)
    candidates = counts.where(F.size("words") >= 2).select("words", F.col("f").alias("a"))
    parts = candidates.select("words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    parts = parts.select("words", "a", "k", F.expr("slice(words, 1, k)").alias("front"), F.expr("slice(words, k + 1, size(words) - k)").alias("back"))
    of_front = counts.select(F.col("words").alias("front"), F.col("f").alias("l"))
    of_back = counts.select(F.col("words").alias("back"), F.col("f").alias("r"))
    exact = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cuts = parts.join(of_front, "front").join(of_back, "back").withColumns(
        {"square": exact["a"] * exact["a"] * F.lit(1000000).cast("decimal(7,0)"), "both": exact["l"] * exact["r"]}
    )
    cuts = cuts.withColumn("score", F.expr("square div both"))
    scored = cuts.groupBy("words").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))

    inner = candidates.where(F.size("words") > 2).select("words", "a", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m"))
    inner = inner.select("a", F.explode(F.expr("transform(sequence(1, size(words) - m + 1), i -> slice(words, i, m))")).alias("words"))
    longer = inner.groupBy("words").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, "words", "left").where(F.coalesce(100 * F.col("longer") < contained_pct * F.col("a"), F.lit(True)))

    names = frequent.select("word_hash", "lang", "word")
    spelled = kept.select("words", F.posexplode("words").alias("at", "word_hash")).join(names, "word_hash")
    spelled = spelled.groupBy("words").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.expr("transform(array_sort(collect_list(struct(at, word))), x -> x.word)"), " ").alias("phrase"),
    )
    found = kept.join(spelled, "words").select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language is cut down in shares first, so that no task sorts all of its phrases
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return found.join(per_lang, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
