import random

import numpy as np
import pytest
import xxhash

from tarnlake.llm import simhash

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text, k=3):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "").translate(FOLD)).split(" ") if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(codes, keys, distance=2):
    """The smallest key of each row's component, by comparing all pairs."""
    codes = np.array(codes, np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
    label = np.arange(len(codes))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return [min(k for k, l in zip(keys, label) if l == mine) for mine in label]
        label = new


def cluster_codes(rng, centres, each, flips):
    codes = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            code = centre
            for _ in range(rng.randint(0, flips)):
                code ^= 1 << rng.randrange(64)
            codes.add(code)
    return sorted(codes)


@pytest.mark.parametrize("distance, flips", [(2, 5), (2, 1), (1, 3), (0, 2)])
def test_links_connect_what_all_pairs_connect(spark, distance, flips):
    codes = cluster_codes(random.Random(flips), 25, 20, flips)
    # A long chain, each code one bit from the next, and its middle missing.
    chain = [0xF0F0 ^ ((1 << k) - 1) for k in range(40)]
    codes = sorted({*codes, *chain, 0, (1 << 64) - 1})
    prints = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    labels = {r["fp"]: r["label"] for r in simhash.components(simhash.near_links(prints, distance)).collect()}
    expected = smallest(codes, range(len(codes)), distance)
    groups = {}
    for code, want in zip(codes, expected):
        groups.setdefault(want, set()).add(labels.get(simhash.signed(code), simhash.signed(code)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_a_crowd_of_near_codes_in_one_node(spark):
    """All subsets of 11 bits: thousands of codes within a few bits of each other, one component."""
    codes = [sum(1 << 5 * b for b in range(11) if n >> b & 1) for n in range(2**11)]
    prints = spark.createDataFrame([(simhash.signed(c),) for c in codes], "fp long")
    edges = simhash.near_links(prints).collect()
    assert len(edges) < 6 * len(codes)
    assert len({r["label"] for r in simhash.components(simhash.near_links(prints)).collect()}) == 1


def test_gray_rank_counts_up_along_the_gray_code(spark):
    codes = [n ^ (n >> 1) for n in range(512)]
    got = spark.createDataFrame([(c,) for c in codes], "c long").select(simhash.gray_rank(simhash.F.col("c"))).collect()
    assert [r[0] for r in got] == list(range(512))


@pytest.mark.parametrize("shingle", [1, 3])
def test_fingerprints_by_hand(spark, oddities, shingle):
    texts = ["", None, "one", "One TWO", "ÄB äb Ab", "a b c", "a  b\tc\n", "x " * 4000, "\xa0 \x1c", "the same the same the same"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs, shingle=shingle).collect()}
    assert got == {i: simhash.signed(fingerprint(t, shingle)) for i, t in enumerate(texts)}


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    rng = random.Random(6)
    for k, (doc, text) in enumerate(rows[:60]):
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows += [(1000 + k, " ".join(words)), (2000 + k, text)]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    codes = [fingerprint(t) for _, t in rows]
    expected = dict(zip([d for d, _ in rows], zip(codes, smallest(codes, [d for d, _ in rows]))))
    assert {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in found} == expected
    assert len({r["component_id"] for r in found}) < len({c for c in codes})


def test_oddities(spark, oddities, nothing):
    rows = simhash.near_duplicates(oddities).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in rows if r["fp"] == 0) == [(-1, 2), (2, 2), (3, 2), (4, 2)]
    assert sorted(r["doc_id"] for r in rows if r["component_id"] == 1) == [1, 6]
    assert [r["component_id"] for r in rows if r["doc_id"] is None and r["fp"]] == [None]
    assert simhash.near_duplicates(nothing).collect() == []


def test_rows_of_one_key_each_keep_their_component(spark, oddities, nothing):
    """Key 5 stands for its own text, and with another text it is a copy of 3."""
    alone, copied = "a text that nobody else has written down", "two documents hold these very words in this order"
    rows = [(5, alone, "x"), (5, copied, "x"), (3, copied, "x"), (5, "some third text under the same key", "x"),
            (None, "nobody knows the key of these words", "x"), (None, "nobody knows the key of these words", "y"),
            (None, copied, "x"), (3, copied, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = [tuple(r) for r in simhash.one_of_each_component(docs).collect()]
    langs = [k[2] for k in kept if k[0] is None]
    assert sorted((k[0] or -1, k[1]) for k in kept) == sorted(
        [(5, alone), (3, copied), (5, rows[3][1]), (-1, rows[4][1])]) and len(langs) == 1
    again = simhash.one_of_each_component(docs.orderBy("lang", ascending=False).repartition(3, "lang"))
    assert sorted(map(str, again.collect())) == sorted(str(r) for r in simhash.one_of_each_component(docs).collect())
    found = simhash.one_of_each_component(oddities)
    assert found.columns == oddities.columns and found.schema == oddities.schema
    assert sorted(r["doc_id"] or -1 for r in found.collect()) == [-1, 1, 2, 5, 5]
    assert simhash.one_of_each_component(nothing).collect() == []
