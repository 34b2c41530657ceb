"""Norm buckets against a plain score of every document, in Python's whole numbers."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tarnlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """Every item's list as (item_id, rank, doc_id, score), by the formula alone."""
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(split(text)) if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return out


def key(row):
    return tuple((v is None, v or 0) for v in row)


def found(docs, items, k, **names):
    return sorted((tuple(r) for r in lexical.search(docs, items, k, **names).collect()), key=key)


def test_terms_are_the_patterns():
    text = "Ab9_c-É 漢字/x\x7fy\x80 [Z]`q`{w}~@A:0;?\t\x1fend"
    assert [t.decode() for t in lexical.terms(text.encode())] == split(text)


@pytest.mark.parametrize("seeds,bucket", [(20_000, 4096), (40, 16), (1, 3)])
def test_all_sizes_of_buckets_are_exact(spark, monkeypatch, seeds, bucket):
    monkeypatch.setattr(lexical, "SEEDS", seeds)
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").limit(12)
    wanted = ranked([tuple(r) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], 7)
    assert found(docs.repartition(3), items, 7) == sorted(wanted, key=key)


def test_pruning_prunes(spark):
    """A floor that only a few reach leaves the rest of a bucket unscored."""
    sf = "/root/testdata/sf0.01"
    docs = lexical._utf8(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text")
    text = spark.read.parquet(f"{sf}/benchmark.parquet").where("item_id = 3").first().text
    vocabulary = sorted(set(lexical.terms(text.encode())))
    vectors = docs.mapInArrow(lexical.TermCounts(vocabulary), lexical.VECTORS)
    import numpy as np
    import pyarrow as pa

    weights = lexical.term_weights({}, len(vocabulary), 1000)
    table = vectors.mapInArrow(lexical.Lengths(weights, 1000, 300_000), lexical.INDEX).sort(F.desc("norm")).toArrow()
    batch = pa.Table.from_batches(table.to_batches()).combine_chunks().to_batches()[0]
    item = [np.arange(len(vocabulary))]
    all_rows = next(lexical.NormBuckets(item, weights, np.zeros(1, np.int64), 10**6)(iter([batch])))
    scores = sorted(all_rows.column(2).to_pylist())
    # A score that no row but the best reaches.
    few = next(lexical.NormBuckets(item, weights, np.array([scores[-1]]), 10**6)(iter([batch])))
    assert few.column(2).to_pylist() == [s for s in scores if s == scores[-1]]
    above = next(lexical.NormBuckets(item, weights, np.array([scores[-1] + 1]), 10**6)(iter([batch])))
    assert above.num_rows == 0


def test_ties_repeats_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS_AT_ONCE", 2)
    monkeypatch.setattr(lexical, "SEEDS", 5)
    rows = [(i, "same words here") for i in range(40)] + [(3, "same words here"), (None, "same words here")]
    rows += [(100 + i, f"other text number {i}") for i in range(20)]
    items = [(1, "words"), (1, "words"), (2, "number OTHER 7"), (None, "here same"), (4, "unknown"), (5, None), (6, " -- "), (7, "same 7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = found(docs, spark.createDataFrame(items, "item_id long, text string"), 45)
    assert got == sorted(ranked(rows, items, 45), key=key)


def test_oddities(spark, oddities, nothing):
    items = spark.createDataFrame(
        [(1, "One plain text of word5 words", 1), (2, "KEY é 漢字", 2)], "id long, query string, text int")
    names = {"item_key": "id", "item_text": "query"}
    wanted = ranked([(r.doc_id, r.text) for r in oddities.collect()], [(r.id, r.query) for r in items.collect()], 50)
    assert found(oddities, items, 50, **names) == sorted(wanted, key=key)
    assert found(nothing, items, 50, **names) == []
    assert found(oddities, items.where("false"), 50, **names) == []
    assert found(oddities.where("text IS NULL"), items, 50, **names) == []
