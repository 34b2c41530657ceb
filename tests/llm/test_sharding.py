from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tarnlake.llm import sharding
from tarnlake.llm.common import cell_rank


def placed(df, shards):
    return sharding.interleave(df, shards).collect()


def test_shards_are_even_gapless_and_mirror_the_mixture(spark):
    docs = spark.range(5000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('s', id % 9) END AS source")
    rows = placed(docs, 24)
    slots = defaultdict(list)
    mixture = defaultdict(Counter)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        mixture[r["source"]][r["shard"]] += 1
    sizes = [len(s) for s in slots.values()]
    assert len(rows) == 5000 and max(sizes) - min(sizes) <= 1 and set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for counts in mixture.values():
        fair = sum(counts.values()) / 24
        assert all(abs(counts[k] - fair) <= 2 for k in range(24))
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in placed(docs.repartition(7), 24)}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


def test_many_sources_of_one_row_are_spread(spark):
    docs = spark.range(600).selectExpr("id AS doc_id", "concat('s', id) AS source")
    firsts = [int(r["doc_id"]) for r in placed(docs, 6) if r["shard"] == 0]
    assert len(firsts) == 100 and max(firsts) > 300


def test_oddities(oddities, nothing):
    rows = placed(oddities, 4)
    assert len(rows) == 10 and rows[0].asDict()["rank"] == 2 and rows[0]["cell"] == "c"
    assert sorted(Counter(r["shard"] for r in rows).values()) == [2, 2, 3, 3]
    assert placed(nothing, 4) == []
    assert sorted(r["shard"] for r in placed(oddities.limit(2), 24)) == [0, 12]


def test_cell_rank_is_the_plain_rank(spark):
    df = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 7) END AS g", "id * 7919 % 3001 AS x",
        "id % 5 AS v").selectExpr("*", "x div 100 AS cell")
    got = {r["id"]: (r["rank"], r["before"], r["group_rows"], r["group_value"])
           for r in cell_rank(df, ["g"], ["x"], value="v").collect()}
    groups = defaultdict(list)
    for r in df.collect():
        groups[r["g"]].append((r["x"], r["id"], r["v"]))
    for rows in groups.values():
        rows.sort()
        ahead = 0
        for k, (_, i, v) in enumerate(rows):
            assert got[i] == (k, ahead, len(rows), sum(r[2] for r in rows))
            ahead += v


def test_rows_under_one_key_are_many_cells(spark):
    """A third of all rows without a key, and a third under one key, are drawn by their own rows."""
    from tarnlake.llm import common

    docs = spark.range(3000).selectExpr("CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 5 ELSE id END AS doc_id", "'a' AS source", "id AS size")
    frame = common.packed(docs, draw=F.xxhash64(F.lit(17), F.col("doc_id"), F.struct("*"))).withColumn(
        "cell", common.hash_cell(F.col("draw"), 30))
    assert max(r["count"] for r in frame.groupBy("cell").count().collect()) < 200
    placed = sharding.interleave(docs, 7)
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    slots = placed.groupBy("shard").agg(F.sort_array(F.collect_list("slot")).alias("s")).collect()
    assert all(r["s"] == list(range(len(r["s"]))) for r in slots)
