"""Cases in which an operator has to do more than its first pass: large buckets, mixed sources, later rounds."""

import random

from pyspark.sql import functions as F
from test_edges import documents, prose

from haulgrain.llm import minhash, pii


def test_all_links_of_a_large_bucket_are_found(spark):
    """One bucket of many unlinked documents with one template, and two pairs that are similar enough."""
    template = prose(50, 60)
    rows = [(i, f"{template} {prose(1000 + i, 20)}") for i in range(200)]
    rows += [(i, f"{template} {prose(2000 + i // 2, 12)} {prose(3000 + i, 4)}") for i in (250, 251, 260, 261)]
    docs = documents(spark, rows)
    nodes = minhash.signatures(docs).select(F.col("doc_id").alias("node"), "n_shingles", "key", F.array(F.lit(1).cast("bigint")).alias("bands"))
    assert sorted(map(tuple, minhash.near_links(nodes, docs).collect())) == [(250, 251), (260, 261)]


def test_trusted_instances_are_evidence_in_later_rounds(spark):
    """A context, a label and a spaced identifier without any seed of their own."""
    r = random.Random(6)
    number = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    tokens = [f"secret={number(4)}x{number(4)}" for _ in range(24)]
    spaced = [f"DE{number(2)} {number(4)} {number(4)} {number(2)}" for _ in range(16)]
    docs = [(1000 + i, f"{prose(i, 12)} reach me under user{number(4)}@mail.example.com today") for i in range(250)]
    docs += [(200 + i, f"{prose(200 + i, 12)} reach me under {x} today") for i, x in enumerate(tokens + spaced)]
    docs += [(300 + i, f"{prose(300 + i, 12)} stored at vault {x} since") for i, x in enumerate(tokens + spaced)]
    docs += [(400, f"{prose(400, 12)} stored at vault {number(4)}-{number(4)} since"), (401, f"{prose(401, 12)} secret={number(4)}y{number(4)}")]
    docs += [(500 + i, f"{prose(500 + i, 12)} version {number(4)}-{number(4)} of it") for i in range(30)]
    found = {x.doc_id: x.spans for x in pii.personal_data(documents(spark, docs)).collect()}
    text = dict(docs)
    assert all("other:" in found[d] for d in (*range(200, 240), *range(300, 340), 400, 401))
    start = text[324].index(spaced[0])
    assert f"other:{start}:{start + len(spaced[0])}" in found[324].split(",")
    assert not any("other:" in found[500 + i] for i in range(30))
