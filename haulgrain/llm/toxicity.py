"""Toxicity scores from weak supervision.

Many voters look at a document: one for each word of a lexicon, one for each stem (the first letters
of words) that labelled documents tie to toxicity, and some that count how dense such hits are.  A
generative label model, fitted by expectation maximisation on a bounded sample of labelled and
unlabelled documents, estimates how often each voter fires on toxic and on clean documents, and how
voters fire together beyond that; voters that repeat each other share their weight.  Its posterior
labels train a logistic regression on stem densities, and that linear classifier scores every
document.  Stems are chosen by Spark from counts over the sample; the fit itself is small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.shared import cut

#: bounds of the sample that the models are fitted on
TOXIC_ROWS, CLEAN_ROWS, UNLABELLED_ROWS = 3000, 6000, 2000
#: stems of the classifier, and the first of them that also vote
STEMS, VOTING_STEMS = 1024, 96
STEM_LENGTHS = range(3, 9)
LEAST_Z = 3.5
THRESHOLD = 0.3
REMEMBERED = 200_000

#: fixed values: English insults, each a voter
LEXICON = (
    "bastard", "clown", "crap", "creep", "cretin", "damn", "despicable", "disgusting", "dumb", "fool", "freak", "garbage",
    "hate", "idiot", "idiotic", "imbecile", "jerk", "kill", "loser", "moron", "nasty", "pathetic", "pig", "rubbish", "scum",
    "shut", "stupid", "sucks", "trash", "ugly", "useless", "vermin", "vile", "worthless",
)

_EDGE = ".,;:!?\"'()[]{}*#$%&|<>-_…¡¿«»“”"


def stems(word: str) -> list[str]:
    """First letters of a cleaned word at several lengths, and the word itself with an end mark."""
    return [word[:n] for n in STEM_LENGTHS if n <= len(word)] + [word + "$"]


def cleaned(token: str) -> str:
    return token.strip(_EDGE)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Classifier:
    """score = logistic(bias + 100 / (words + 20) * sum of the weights of all words' stems)."""

    weights: dict[str, float]
    bias: float

    def scorer(self):
        weights = self.weights

        class Known(dict):
            def __missing__(self, token: str) -> float:
                value = sum(weights.get(s, 0.0) for s in stems(cleaned(token)))
                if len(self) >= REMEMBERED:
                    self.clear()
                self[token] = value
                return value

        known = Known()

        def score(text: str | None) -> float:
            tokens = text.lower().split() if text else []
            logit = self.bias + 100.0 / (len(tokens) + 20) * sum(map(known.__getitem__, tokens))
            return float(1.0 / (1.0 + np.exp(-np.clip(logit, -30.0, 30.0))))

        return score


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Bounded rows (doc_id, text, label): labelled 1 or 0, unlabelled null; never a held-out document."""
    own = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
    )
    known = docs.where("doc_id is not null").where(~held_out(F.col("doc_id"))).select(F.col("doc_id").cast("bigint"))
    marked = known.distinct().join(own, "doc_id", "left")
    turn = F.xxhash64("doc_id", F.lit("sample"))
    parts = [
        marked.where(F.col("label") == 1).orderBy(turn).limit(TOXIC_ROWS),
        marked.where(F.col("label") == 0).orderBy(turn).limit(CLEAN_ROWS),
        marked.where("label is null").orderBy(turn).limit(UNLABELLED_ROWS),
    ]
    # at most TOXIC_ROWS + CLEAN_ROWS + UNLABELLED_ROWS ids
    chosen = F.broadcast(cut(parts[0].union(parts[1]).union(parts[2])))
    return docs.select(F.col("doc_id").cast("bigint"), "text").join(chosen, "doc_id")


def stem_counts(sample: DataFrame) -> DataFrame:
    """Rows (stem, toxic, clean): labelled documents of each class that have the stem."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part, counts = batch.slice(lo, 200), {}
                for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                    if text and label is not None:
                        words = {cleaned(t) for t in text.lower().split()}
                        for stem in {s for w in words if len(w) > 1 for s in stems(w)}:
                            counts.setdefault(stem, [0, 0])[1 - label] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(counts.keys(), pa.string()),
                        *(pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1)),
                    ],
                    names=["stem", "toxic", "clean"],
                )

    counted = sample.select("text", "label").mapInArrow(work, "stem string, toxic bigint, clean bigint")
    return counted.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def chosen_stems(sample: DataFrame) -> list[str]:
    """The stems that labelled documents tie to toxicity most surely, at most ``STEMS``."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    share = (F.col("toxic") + F.col("clean")) / (toxic + clean)
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    z = (F.col("toxic") / toxic - F.col("clean") / clean) / spread
    best = stem_counts(sample).where("toxic >= 3").where(share < 1).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    return [r["stem"] for r in best.orderBy(F.desc("z"), F.length("stem"), "stem").limit(STEMS).collect()]


def hits(sample: DataFrame, names: list[str]) -> tuple[np.ndarray, ...]:
    """Per sampled document its label (-1: none) and words; per hit its document, stem and count."""
    index = {name: i for i, name in enumerate(names)}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                tokens, counts = text.lower().split() if text else [], {}
                for token in tokens:
                    for stem in stems(cleaned(token)):
                        if stem in index:
                            counts[index[stem]] = counts.get(index[stem], 0) + 1
                rows.append({"label": -1 if label is None else label, "words": len(tokens), "stem": list(counts), "count": list(counts.values())})
            kind = pa.schema(
                [("label", pa.int64()), ("words", pa.int64()), ("stem", pa.list_(pa.int64())), ("count", pa.list_(pa.int64()))]
            )
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    found = sample.select("text", "label").mapInArrow(work, "label bigint, words bigint, stem array<bigint>, count array<bigint>").collect()
    found.sort(key=lambda r: (r["label"], r["words"], r["stem"], r["count"]))
    labels, words = (np.array([r[c] for r in found], np.int64) for c in ("label", "words"))
    row = np.repeat(np.arange(len(found)), [len(r["stem"]) for r in found])
    stem = np.array([s for r in found for s in r["stem"]], np.int64)
    count = np.array([c for r in found for c in r["count"]], np.float64)
    return labels, words, row, stem, count


def votes(names: list[str], words, row, stem, count) -> np.ndarray:
    """Documents by voters, 1 where a voter fires.  Silence also speaks: it is less likely if toxic."""
    fired = np.zeros((len(words), len(names)), bool)
    fired[row, stem] = True
    whole = {n for n in names if n.endswith("$")}
    lexicon = [i for i, n in enumerate(names) if n in {w + "$" for w in LEXICON}]
    voting: list[int] = []
    for i, name in enumerate(names):  # best first; a longer form of a stem that votes adds nothing
        if len(voting) < VOTING_STEMS and name not in whole and not any(name.startswith(names[j]) for j in voting):
            voting.append(i)
    known = np.zeros(len(names), bool)
    known[lexicon + voting] = True
    dense = np.bincount(row, weights=count * known[stem], minlength=len(words)) / (words + 20)
    columns = [fired[:, i] for i in lexicon + voting] + [dense > limit for limit in (0.004, 0.01, 0.02)]
    return np.stack(columns, axis=1).astype(np.float64)


def label_model(fired: np.ndarray, labels: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Posterior probability of toxic for each document; labelled ones pin the model down."""
    n, m = fired.shape
    given = labels >= 0
    prior = float(np.clip(labels[given].mean() if given.any() else 0.1, 0.01, 0.5))
    on_toxic, on_clean, share = np.full(m, 0.3), np.full(m, 0.01), np.ones(m)
    posterior = np.where(given, labels, prior).astype(np.float64)
    for step in range(rounds):
        if step or given.any():
            t, c = posterior.sum(), (1 - posterior).sum()
            on_toxic = (fired.T @ posterior + 0.5) / (t + 1)
            on_clean = (fired.T @ (1 - posterior) + 0.5) / (c + 1)
        if step == rounds // 2 and n > 2:
            # correlations of the voters that the class doesn't explain: voters that repeat each other share their weight
            left = fired - posterior[:, None] * on_toxic - (1 - posterior)[:, None] * on_clean
            deviation = np.sqrt((left**2).mean(axis=0)) + 1e-9
            together = (left.T @ left) / n / np.outer(deviation, deviation)
            np.fill_diagonal(together, 0)
            share = 1 / (1 + np.clip(together, 0, None).sum(axis=1))
        yes, no = np.log(on_toxic / on_clean), np.log((1 - on_toxic) / (1 - on_clean))
        logit = np.log(prior / (1 - prior)) + fired @ (share * yes) + (1 - fired) @ (share * no)
        posterior = np.where(given, labels, 1 / (1 + np.exp(-np.clip(logit, -30, 30))))
    return posterior


def logistic(posterior: np.ndarray, words, row, stem, count, width: int, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on stem densities with a small ridge, by Adam's steps."""
    value = count * (100.0 / (words[row] + 20))
    weights, bias = np.zeros(width), -2.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    n = max(1, len(posterior))
    for step in range(1, steps + 1):
        logit = bias + np.bincount(row, weights=value * weights[stem], minlength=len(posterior))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - posterior) / n
        gradient = np.append(np.bincount(stem, weights=value * error[row], minlength=width) + 1e-4 * weights, error.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier; without labelled documents of both classes the lexicon alone counts."""
    sample = cut(sample_of(docs, labels))
    found = chosen_stems(sample)
    if not found:
        return Classifier({w + "$": 2.0 for w in LEXICON}, -3.0)
    names = found + sorted({w + "$" for w in LEXICON} - set(found))
    labelled, words, row, stem, count = hits(sample, names)
    posterior = label_model(votes(names, words, row, stem, count), labelled)
    weights, bias = logistic(posterior, words, row, stem, count, len(names))
    return Classifier({n: float(w) for n, w in zip(names, weights, strict=True) if w}, bias)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row (doc_id, held_out, score, predicted) per document.

    Only texts are scored.  Labels are learnt from rows with crc32(doc_id as text) mod 4 other than
    2; of a document's repeated labels the toxic one counts.  A null or empty text gets the score of
    a text without words.  A document without an id isn't held out and teaches nothing.  Repeated
    documents give repeated rows.  Other columns are ignored.
    """
    model = fit(docs, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            scores = pa.array([score(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't predicted toxic; all columns and repeated rows as they came."""
    model = fit(docs, labels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            yield batch.filter(pa.array([score(t.as_py()) < THRESHOLD for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
