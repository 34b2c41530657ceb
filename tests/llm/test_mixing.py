import re
from collections import defaultdict

import pytest

from tarnlake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_stop_at_three_sizes_and_share_the_rest():
    got = mixing.shares({"b": 10, "a": 1000, None: 10, "c": 500})
    assert sum(got.values()) == pytest.approx(1520)
    # By hand: weights a 1, b 2, c 3, null 1; b and null are full at 30, c and a share what is left 3 to 1.
    assert got == pytest.approx({"a": 365.0, "b": 30.0, "c": 1095.0, None: 30.0})
    assert mixing.shares({}) == {} and mixing.shares({"a": 0}) == {"a": 0.0}


def test_golden_points_are_even(spark):
    n = 3_000_000
    points = spark.range(n - 1000, n).select(mixing.golden_point(mixing.F.col("id")).alias("p")).collect()
    exact = [float(mixing.GOLDEN * k % 1) for k in range(n - 1000, n)]
    assert max(abs(r["p"] - e) for r, e in zip(points, exact)) < 1e-9
    for low, high in ((0.0, 0.1), (0.33, 0.5), (0.9, 1.0)):
        assert abs(sum(low <= e < high for e in exact) - 1000 * (high - low)) <= 3


def replay(spark, docs):
    """The mix by brute force: every slot in order takes the next block of its source, word by word."""
    rows = mixing.mix(docs).collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    return rows, by_source


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_taken_words_come_near_their_targets(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    rows, by_source = replay(spark, docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    targets = mixing.shares({s: sum(r["size"] for r in rs) for s, rs in by_source.items()})
    for source, own in by_source.items():
        assert {r["source_size"] for r in own} == {sum(r["size"] for r in own)}
        assert {r["target"] for r in own} == {targets[source]}
        assert sum(r["taken"] for r in own) == pytest.approx(targets[source], rel=0.03)
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        assert sum(r["taken_by_epoch"]) == r["taken"] and r["taken_by_epoch"] == sorted(r["taken_by_epoch"], reverse=True)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_blocks_taken_are_those_of_the_schedule(spark):
    docs = spark.range(120).selectExpr(
        "id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', int(1 + id * 37 % 90)) AS text")
    rows, by_source = replay(spark, docs)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by_source.items()}
    targets = mixing.shares(sizes)
    block = mixing.block_words(targets)
    strata = sorted(sizes)
    blocks = {s: -(-sizes[s] // block) for s in strata}
    wanted = [targets[s] * blocks[s] / sizes[s] for s in strata]
    slots = mixing.schedule(spark, [(s, targets[s], blocks[s]) for s in strata], wanted).collect()
    assert sorted(r["slot"] for r in slots) == list(range(round(sum(wanted))))
    taken = defaultdict(int)
    for r in slots:
        if r["epoch"] < 3:
            taken[r["stratum"]] += min(block, sizes[r["stratum"]] - r["block"] * block)
    for s in strata:
        assert sum(r["taken"] for r in by_source[s]) == taken[s]


def test_documents_of_the_mix(spark):
    docs = spark.range(90).selectExpr(
        "id AS doc_id", "concat('s', id % 3) AS source", "concat(repeat('w  ', int(1 + id * 37 % 90)), 'end\n') AS text",
        "0L AS n_chars", "'kept' AS size")
    taken = {r["doc_id"]: r for r in mixing.mix(docs.drop("size")).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and r["size"] == "kept"
    assert dict(words) == {d: r["taken"] for d, r in taken.items() if r["taken"]}


def test_oddities(oddities, nothing):
    rows = mixing.mix(oddities).collect()
    assert len(rows) == 10 and all(r["taken"] <= 3 * r["size"] and r["row"] == 1 for r in rows)
    assert all(r["size"] == len(WORD.findall(r["text"] or "")) for r in rows)
    assert mixing.mix(nothing).collect() == []
    assert mixing.mixed_documents(oddities).columns == oddities.columns
    empty = oddities.where("text IS NULL")
    assert [r["taken"] for r in mixing.mix(empty).collect()] == [0, 0]


def test_rows_under_one_key_are_shuffled_apart(spark):
    """A third of all rows without a key and a third under one key: rows of both, and of the rest, are taken alike."""
    docs = spark.range(3000).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE id END AS doc_id", "IF(id < 1500, 'a', 'b') AS source",
        "concat('w', id, repeat(' w', int(id % 7))) AS text", "id AS own")
    rows = mixing.mix(docs).collect()
    assert sorted(r["own"] for r in rows) == list(range(3000))
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
    for own in by_source.values():
        assert sum(r["taken"] for r in own) == pytest.approx(own[0]["target"], rel=0.03)
        share = own[0]["target"] / own[0]["source_size"]
        for third in range(3):
            some = [r for r in own if r["own"] % 3 == third]
            assert sum(r["taken"] for r in some) == pytest.approx(share * sum(r["size"] for r in some), rel=0.15)
    again = {r["own"]: r["taken"] for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r["own"]: r["taken"] for r in rows}


def test_facts_of_the_sources_need_no_workers(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mix(docs)._jdf.queryExecution().sparkPlan().toString()
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
