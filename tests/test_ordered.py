"""The chunked windows against the plain ones, on groups with one hot key, ties, nulls and hot values."""

import pytest
from pyspark.sql import functions as F

from tarnlake.operators import ordered as o


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    return spark.range(4000).select(
        n,
        F.when(n % 3 != 0, "hot").when(n % 31 == 0, None).otherwise(F.concat(F.lit("k"), n % 17)).alias("key"),
        F.when(n % 3 == 1, 77).when(n % 41 == 0, None).otherwise((n * 7919) % 501).alias("at"),
        ((n * 31) % 211).alias("amount"),
        (((n * 131) % 997) / 4.0).alias("x"),
        F.when(n % 4 != 0, ((n * 17) % 301).cast("decimal(18,2)") / 1).cast("decimal(18,2)").alias("price"),
    ).cache()


def same(a, b):
    columns = sorted(b.columns)
    kinds = [[(f.name, f.dataType) for f in df.select(*columns).schema.fields] for df in (a, b)]
    assert kinds[0] == kinds[1]
    left = sorted(map(repr, a.select(*columns).collect()))
    right = sorted(map(repr, b.select(*columns).collect()))
    assert left == right


@pytest.mark.parametrize("descending", [False, True])
def test_row_numbers(rows, descending):
    order = [o.Order("at", descending), o.Order("id")]
    same(o.number_rows(rows, ["key"], order, "n", 7), o.number_rows(rows, ["key"], order, "n", 1))


def chunk_sizes(df):
    return sorted(r["count"] for r in df.groupBy(o.CHUNK).count().collect())


def test_hot_value_is_cut_along_second_column(rows):
    placed = o.with_chunks(rows, ["key"], ["at", "id"], 12)
    assert max(chunk_sizes(placed)) < 900
    assert placed.filter("at = 77").select(o.CHUNK).distinct().count() > 3
    # A hot decimal, and rows that tie in all but their group.
    prices = rows.selectExpr("key", "IF(id % 2 = 0, 1.50BD, price) AS price", "CAST(id AS string) AS name")
    assert max(chunk_sizes(o.with_chunks(prices, [], ["price", o.Order("name", True)], 10))) < 1000


def test_running_total_shares_ties(rows):
    same(o.running_total(rows, ["key"], "at", "amount", "t", 6), o.running_total(rows, ["key"], "at", "amount", "t", 1))


def test_rank(rows):
    by = o.Order("amount", True)
    same(o.rank_rows(rows, ["key"], by, "r", 6), o.rank_rows(rows, ["key"], by, "r", 1))


def test_median_and_quantile(rows):
    same(o.median_per_group(rows, ["key"], "x", "m", 5), o.median_per_group(rows, ["key"], "x", "m", 1))
    same(o.value_at_fraction(rows, ["key"], "x", 0.9, "q", 5), o.value_at_fraction(rows, ["key"], "x", 0.9, "q", 1))


def test_neighbours(rows):
    steps = {
        "prev": lambda w: F.lag("x").over(w),
        "jump": lambda w: F.col("x") - F.col("prev"),
        "mean": lambda w: F.round(F.avg("jump").over(w.rowsBetween(-3, 0)), 9),
        "ahead": lambda w: F.lead("x", 2).over(w),
    }
    cut = o.with_neighbours(rows, ["key"], ["id"], 4, 2, steps, chunks=5, block_rows=50)
    same(cut, o.with_neighbours(rows, ["key"], ["id"], 4, 2, steps, chunks=1))


def test_small_tables_take_the_plain_window(rows, spark):
    assert o.chunk_count(spark.range(10)) == 1
    assert o.chunk_count(spark.range(10**9)) > 1
    plan = o.number_rows(rows, ["key"], ["id"], "n")._jdf.queryExecution().toString()
    assert o.CHUNK not in plan


def test_without_keys_and_by_text(rows):
    named = rows.withColumn("name", F.concat(F.coalesce("key", F.lit("Ünï")), F.lit("-"), F.col("amount") % 7))
    order = ["name", "id"]
    same(o.number_rows(named, [], order, "n", 6), o.number_rows(named, [], order, "n", 1))
    same(o.number_rows(named, ["key"], [o.Order("name", True), "id"], "n", 6),
         o.number_rows(named, ["key"], [o.Order("name", True), "id"], "n", 1))
    same(o.running_total(named, [], "name", "amount", "t", 6), o.running_total(named, [], "name", "amount", "t", 1))
    same(o.median_per_group(rows, [], "x", "m", 4), o.median_per_group(rows, [], "x", "m", 1))
    assert len(chunk_sizes(o.with_chunks(named, ["key"], ["name"], 6))) > 1


def test_signed_zero_and_nan_order_like_the_window(spark):
    odd = spark.sql("SELECT id, CASE WHEN id % 5 = 0 THEN -0.0D WHEN id % 5 = 1 THEN 0.0D WHEN id % 7 = 0 THEN "
                    "double('NaN') WHEN id % 11 = 0 THEN NULL ELSE id % 13 - 6.0D END AS x FROM range(500)")
    for descending in (False, True):
        order = [o.Order("x", descending), "id"]
        same(o.number_rows(odd, [], order, "n", 5).select("id", "n"), o.number_rows(odd, [], order, "n", 1).select("id", "n"))
        by = o.Order("x", descending)
        same(o.rank_rows(odd, [], by, "r", 5).select("id", "r"), o.rank_rows(odd, [], by, "r", 1).select("id", "r"))


def test_null_and_decimal_amounts_give_one_value_and_one_type(rows, spark):
    for order in ("at", "id"):
        same(o.running_total(rows, ["key"], order, "price", "t", 6), o.running_total(rows, ["key"], order, "price", "t", 1))
    same(o.median_per_group(rows, ["key"], "price", "m", 5), o.median_per_group(rows, ["key"], "price", "m", 1))
    leading = spark.sql("SELECT id, CASE WHEN id >= 40 THEN id END AS v FROM range(100)")
    cut = o.running_total(leading, [], "id", "v", "t", 8)
    same(cut, o.running_total(leading, [], "id", "v", "t", 1))
    assert cut.filter("t IS NULL").count() == 40


def test_texts_are_cut_evenly(spark):
    """One name unlike all others changes nothing."""
    names = spark.range(100_000).selectExpr("concat('Customer#', lpad(id, 9, '0')) AS name").union(
        spark.sql("SELECT 'A'"))
    sizes = chunk_sizes(o.with_chunks(names, [], ["name"], 8))
    assert len(sizes) == 8 and max(sizes) < 20_000


def test_only_heavy_groups_are_cut(rows):
    seen = {}

    def plain(some):
        seen["plain"] = {r["key"] for r in some.select("key").distinct().collect()}
        return some.withColumn("n", o.F.lit(0))

    def cut(some, n):
        seen["cut"], seen["chunks"] = {r["key"] for r in some.select("key").distinct().collect()}, n
        return some.withColumn("n", o.F.lit(1))

    done = o.by_weight(rows, ["key"], 10, plain, cut)
    assert seen["cut"] == {"hot"} and None in seen["plain"] and "hot" not in seen["plain"] and seen["chunks"] == 7
    assert done.count() == 4000
    # No group is heavier than half of the table but one; without keys there is one group.
    o.by_weight(rows.filter("key <> 'hot' OR key IS NULL"), ["key"], 3, plain, None)
    o.by_weight(rows, [], 3, None, cut)
    assert seen["cut"] == seen["plain"] | {"hot"} and seen["chunks"] == 3
