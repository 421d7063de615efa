"""Quality rules as a short-circuit cascade.

All counts come from one vectorised pass over the whole text.  The rules of ``RULES`` each look at a
measure of their own; measuring stops at the first rule that rejects a document.  On a bounded
sample of documents every rule is timed and its rejections are counted, and the rules then run in
the order of rejections per second.  The order changes the work, never the verdict: a document is
kept if no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrain.llm import kernel as K

#: rows on which costs and rejections are estimated; only the order of the rules depends on them
SAMPLE_ROWS = 512
RUN = 5

_SYMBOL = K.byte_table(lambda b: b in b"#*$%&|<>")
_CONTINUES = K.byte_table(lambda b: 0x80 <= b < 0xC0)
_UPPER = K.byte_table(lambda b: 0x41 <= b <= 0x5A)
_END = K.byte_table(lambda b: b in b".!?")


class Texts:
    """A chunk of whole texts with the counts that the rules share, each made when first asked for."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets, self.n = buf, offsets, len(offsets) - 1
        self._made: dict[str, object] = {}

    def made(self, name: str, make: Callable):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def words(self):
        return self.made("words", lambda: K.spans(K.NON_SPACE[self.buf], self.offsets))

    def prefix(self):
        return self.made("prefix", lambda: K.prefix_hash(self.buf))

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def n_words(self) -> np.ndarray:
        return np.diff(self.words()[2])

    def word_chars(self) -> np.ndarray:
        return self.made("chars", lambda: self.per_text(K.NON_SPACE[self.buf] & ~_CONTINUES[self.buf]))

    def n_symbols(self) -> np.ndarray:
        return self.made("symbols", lambda: self.per_text(_SYMBOL[self.buf]))

    def n_dup_lines(self) -> np.ndarray:
        return self.made("lines", self._dup_lines)

    def n_repeat_words(self) -> np.ndarray:
        return self.made("repeats", self._repeat_words)

    def _dup_lines(self) -> np.ndarray:
        starts, ends, first = K.split(self.buf, self.offsets, 10)
        total = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(K.NON_SPACE[self.buf], out=total[1:])
        owner = K.owners(first)
        worded = total[ends] > total[starts]
        starts, ends, owner = starts[worded], ends[worded], owner[worded]
        return again(owner, K.span_hash(self.prefix(), starts, ends), self.n)

    def _repeat_words(self) -> np.ndarray:
        starts, ends, first = self.words()
        hashes, at, _ = K.grams(K.span_hash(self.prefix(), starts, ends), first, RUN)
        owner = K.owners(first)
        order = np.lexsort((hashes, owner[at])) if len(at) else np.zeros(0, np.int64)
        h, o = hashes[order], owner[at][order]
        same = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        edge = np.zeros(len(starts) + 1, np.int64)
        np.add.at(edge, at[order[twice]], 1)
        np.add.at(edge, at[order[twice]] + RUN, -1)
        covered = np.cumsum(edge)[:-1] > 0
        return np.bincount(owner[covered], minlength=self.n)


def again(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Per text: how many of its hashes occurred earlier in it."""
    if not len(owner):
        return np.zeros(n, np.int64)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    return np.bincount(o[1:][(h[1:] == h[:-1]) & (o[1:] == o[:-1])], minlength=n)


@dataclass(frozen=True)
class Rule:
    """``rejects`` says for each text of a chunk whether the rule turns it down."""

    name: str
    rejects: Callable[[Texts], np.ndarray]


def _upper_words(t: Texts) -> np.ndarray:
    """Words with a capital and no small letter among A-Z and a-z; other letters count as neither."""
    starts, ends, first = t.words()
    large = np.zeros(len(t.buf) + 1, np.int64)
    np.cumsum(_UPPER[t.buf], out=large[1:])
    ascii_small = np.zeros(len(t.buf) + 1, np.int64)
    np.cumsum((t.buf >= 0x61) & (t.buf <= 0x7A), out=ascii_small[1:])
    shouted = (large[ends] > large[starts]) & (ascii_small[ends] == ascii_small[starts]) & (ends - starts > 1)
    return np.bincount(K.owners(first)[shouted], minlength=t.n)


def _bars(t: Texts) -> np.ndarray:
    return t.per_text(t.buf == ord("|"))


RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols() > t.word_chars()),
    Rule("repeated lines", lambda t: 10 * t.n_dup_lines() > 3 * t.per_text(t.buf == 10) + 3),
    Rule("word length", lambda t: (t.word_chars() < 2 * t.n_words()) | (t.word_chars() > 15 * t.n_words())),
    Rule("shouting", lambda t: 2 * _upper_words(t) > t.n_words()),
    Rule("table cells", lambda t: 5 * _bars(t) > t.n_words()),
    Rule("sentence ends", lambda t: 500 * t.per_text(_END[t.buf]) < t.n_words()),
)


def base_failed(t: Texts) -> np.ndarray:
    return (t.n_words() < 10) | (100 * t.n_repeat_words() > 20 * t.n_words())


def measured(docs: DataFrame, rules: tuple[Rule, ...], sample_rows: int) -> list[dict]:
    """Cost and rejection rate of each rule on at most ``sample_rows`` documents, cheapest rejection first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in K.chunks(batch.column("text")):
                rows = []
                for i, rule in enumerate(rules):
                    texts = Texts(buf, offsets)
                    start = time.perf_counter()
                    rejected = int(rule.rejects(texts).sum())
                    rows.append({"rule": i, "seconds": time.perf_counter() - start, "rejected": rejected, "seen": texts.n})
                yield pa.RecordBatch.from_pylist(rows)

    shape = "rule bigint, seconds double, rejected bigint, seen bigint"
    sample = docs.select("text").limit(sample_rows)
    figures = sample.mapInArrow(work, shape).groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("seconds", "rejected", "seen")))
    found = {r["rule"]: r.asDict() for r in figures.collect()}
    rows = [found.get(i, {"rule": i, "seconds": 0.0, "rejected": 0, "seen": 0}) for i in range(len(rules))]
    return sorted(rows, key=lambda r: (-r["rejected"] / max(r["seconds"], 1e-9), r["rule"]))


SHAPE = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, rejected_by string"
)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document with its base counts, base_failed, kept, and the rule that rejected it.

    ``rejected_by`` is ``base``, the name of a rule or null; where several rules would reject a
    document, it is the one that ran first.  A null, empty or blank text has no words: all counts
    but n_symbols are 0 and the base fails.  Repeated documents give repeated rows, an empty table
    none.  Other columns are ignored.
    """
    order = [rules[r["rule"]] for r in measured(docs, rules, sample_rows)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in K.chunks(batch.column("text")):
                texts = Texts(buf, offsets)
                failed = base_failed(texts)
                by = np.where(failed, "base", None).astype(object)
                open_rows = np.flatnonzero(~failed)
                for rule in order:
                    if not len(open_rows):
                        break
                    rejected = rule.rejects(narrowed(texts, open_rows))
                    by[open_rows[rejected]] = rule.name
                    open_rows = open_rows[~rejected]
                counts = (texts.n_words(), texts.word_chars(), texts.n_symbols(), texts.n_dup_lines(), texts.n_repeat_words())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(failed),
                        pa.array([x is None for x in by]),
                        pa.array(by.tolist(), pa.string()),
                    ],
                    names=[c.split()[0] for c in SHAPE.split(", ")],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, SHAPE)


class _Narrowed(Texts):
    """Some texts of a chunk; the counts that the chunk already has are taken over."""

    def __init__(self, whole: Texts, rows: np.ndarray):
        lengths = (whole.offsets[1:] - whole.offsets[:-1])[rows]
        inside = np.zeros(len(whole.buf), bool)
        for row in rows:
            inside[whole.offsets[row] : whole.offsets[row + 1]] = True
        super().__init__(whole.buf[inside], np.concatenate([[0], np.cumsum(lengths)]))
        self._whole, self._rows = whole, rows
        for name in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            setattr(self, name, lambda name=name: getattr(whole, name)()[rows])


def narrowed(texts: Texts, rows: np.ndarray) -> Texts:
    return texts if len(rows) == texts.n else _Narrowed(texts, rows)
