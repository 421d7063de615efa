"""Personal data by bootstrapped contextual extraction.

Base patterns find e-mail addresses, IPv4 addresses, card and phone numbers; these are the seeds.
Candidates are other stretches that look like identifiers: a token with digits, or a run of digit
groups.  A pattern is a piece of context: the word before, the two words before, the word before
with the word after, or the label inside the token (``password=``).  Patterns and instances form a
bipartite graph that Spark scores in rounds: a pattern's score is the share of seeds and trusted
instances among all its instances, or rather the lower end of that share's confidence interval, so
that a few lucky instances don't count; an instance is trusted once its best pattern is
trusted.  Trusted patterns then mark candidates everywhere as kind ``other``.

The graph is aggregated to (pattern, instance) before each round, so a context with a third of all
rows is a count, not a group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrain.llm.shared import cut

KINDS = ("email", "ip", "card", "phone")

#: a pattern is trusted from this score on; Z is the width of the interval in standard deviations
TRUST, Z = 0.75, 2.0
#: seeds or instances trusted in an earlier round that a trusted pattern has at least
LEAST_GOOD = 5
ROUNDS = 3

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: identifier-like: a token with a digit, of six characters at least
_CANDIDATE = re.compile(r"(?<![^ \t-\r])(?=[^ \t-\r0-9]*[0-9])[^ \t-\r]{6,}")
#: two digit groups or more, or such an account number: two letters and two digits, then groups of up to four
_GROUPS = re.compile(r"(?<![^ \t-\r])(?:[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4})+(?: [A-Z0-9]{1,3})?|[0-9]{2,}(?: [0-9]{2,})+)(?![A-Za-z0-9])")
_LABEL = re.compile(r"[A-Za-z_]+(?=[=:])")
_WORD = re.compile(r"[^ \t-\r]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that don't overlap; each @ is looked at once, so the time is linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        else:
            done = max(done, at)
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    numbers = [ord(c) - 48 for c in reversed(digits)]
    return (sum(numbers[::2]) + sum(_DOUBLED[n] for n in numbers[1::2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() >= 14:
            digits = run.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in run.group()) <= 15:
            yield run.span()


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind."""
    found = []
    if "@" in text:
        found += [(s, 0, e) for s, e in emails(text)]
    found += [(s, 1, e) for s, e in addresses(text)] if "." in text else []
    found += [(s, 2, e) for s, e in cards(text)]
    if "+" in text:
        found += [(s, 3, e) for s, e in phones(text)]
    return sorted(found)


def contexts(text: str, start: int, end: int) -> list[str]:
    """Patterns around a span, at most four; words are lower-cased and freed of punctuation."""

    def clean(word: str) -> str:
        return word.strip(".,;:!?()[]\"'").lower()[:40]

    before = [clean(w) for w in _WORD.findall(text, max(0, start - 120), start)[-2:]]
    after = _WORD.search(text, end)
    last = before[-1] if before else "^"
    out = [f"1 {last}", f"2 {before[0]} {last}" if len(before) == 2 else f"2 ^ {last}"]
    out.append(f"3 {last} _ {clean(after.group()) if after and after.start() - end < 4 else '$'}")
    label = _LABEL.match(text, start)
    return out + ([f"4 {label.group().lower()}"] if label and label.end() < end else [])


def shape(text: str) -> str:
    """Form of an instance: runs of letters, digits and other characters, without their lengths."""
    return re.sub(r"9+", "9", re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", "a", text)))[:40]


FOUND = "doc_key bigint, text_key bigint, start int, end int, kind int, instance string, form string, patterns array<string>"
#: documents with the same key have the same text, and so the same spans
KEY = ("doc_key", "text_key")


def mentions(docs: DataFrame) -> DataFrame:
    """Base spans (kind 0 to 3) and candidates (kind 4) of all texts with their contexts.

    The key is the document's id with a hash of its text, so repeated rows share it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        integers, string = [pa.int64()] * 2 + [pa.int32()] * 3, pa.string()
        schema = pa.schema(list(zip([c.split()[0] for c in FOUND.split(", ")], [*integers, string, string, pa.list_(string)], strict=True)))
        for batch in batches:
            keys, rows = list(zip(*(batch.column(k).to_pylist() for k in KEY), strict=True)), []
            for key, text in zip(keys, (t.as_py() for t in batch.column("text")), strict=True):
                if not text:
                    continue
                spans = base_spans(text)
                taken = sorted((s, e) for s, _, e in spans)
                for s, kind, e in spans:
                    rows.append((*key, s, e, kind, text[s:e], shape(text[s:e]), contexts(text, s, e)))
                tokens, groups = _CANDIDATE.finditer(text), _GROUPS.finditer(text)
                for s, e in sorted({m.span() for m in tokens} | {m.span() for m in groups}):
                    while s < e and text[e - 1] in ".,;:!?)]\"'":
                        e -= 1
                    if e - s >= 6 and not overlaps(taken, s, e):
                        rows.append((*key, s, e, 4, text[s:e][:200], shape(text[s:e]), contexts(text, s, e)))
                if len(rows) > 20_000:
                    yield table_of(rows, schema)
                    rows = []
            if rows:
                yield table_of(rows, schema)

    return docs.select(*keys_of(), "text").mapInArrow(work, FOUND)


def keys_of() -> list:
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_key"), F.xxhash64("text").alias("text_key")]


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def overlaps(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    from bisect import bisect_left

    at = bisect_left(taken, (end, 0))
    return any(e > start for _, e in taken[max(0, at - 4) : at])


def trusted_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns (pattern, form) whose instances are mostly seeds or trusted, after some rounds."""
    edges = cut(
        found.select(F.explode("patterns").alias("pattern"), "form", "instance", (F.col("kind") < 4).alias("seed"))
        .groupBy("pattern", "instance", "form")
        .agg(F.max("seed").alias("seed"))
    )
    believed = edges.where("seed").select("instance").distinct()
    scores = None
    n, share = F.col("n"), F.col("good") / F.col("n")
    lower = (share + Z * Z / (2 * n) - Z * F.sqrt((share * (1 - share) + Z * Z / (4 * n)) / n)) / (1 + Z * Z / n)
    for _ in range(rounds):
        marked = edges.join(believed.withColumn("yes", F.lit(1)), "instance", "left")
        scores = (
            marked.groupBy("pattern")
            .agg(
                F.count("*").alias("n"), F.sum(F.coalesce("yes", F.lit(0))).alias("good"),
            )
            .where((F.col("good") >= LEAST_GOOD) & (lower >= TRUST))
            .select("pattern")
        )
        scores = cut(scores)
        believed = cut(
            believed.union(edges.join(scores, "pattern", "left_semi").select("instance")).distinct()
        )
    return scores


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, the hash of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, by start and then kind; the spans that the trusted
    patterns add have the kind ``other`` and never overlap a base span.  A null or empty text has
    none.  Repeated documents give repeated rows.  Other columns are ignored.
    """
    found = cut(mentions(docs).distinct())
    trusted = trusted_patterns(found)
    added = (
        found.where("kind = 4")
        .withColumn("pattern", F.explode("patterns"))
        .join(trusted, "pattern", "left_semi")
        .select(*KEY, "start", "kind", "end")
        .distinct()
    )
    spans = found.where("kind < 4").select(*KEY, "start", "kind", "end").union(added)
    listed = spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))

    def text(spans):
        named = F.transform(
            spans,
            lambda x: F.concat_ws(":", F.element_at(F.array(*(F.lit(k) for k in (*KINDS, "other"))), x["kind"] + 1), x["start"], x["end"]),
        )
        return F.array_join(named, ",")

    keyed = docs.select(F.col("doc_id").cast("bigint"), *keys_of())
    joined = keyed.join(listed, list(KEY), "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    )
    base = F.filter("spans", lambda x: x["kind"] < 4)

    def count_of(number: int):
        return F.size(F.filter("spans", lambda x: x["kind"] == number)).cast("bigint")

    counts = [count_of(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return joined.select(
        "doc_id", *counts, F.sha2(F.encode(text(base), "UTF-8"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans")
    )
