import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from tarnlake import scratch, sizing
from tarnlake.sources import copyjobs, keyed, readers, upsert, writers

PRODUCTS = {"id": "int", "product_name": "string", "price": "double", "date_created": "string"}


@pytest.fixture()
def products(spark):
    rows = [(1, "Product A", 100.0, "2024-01-01"), (2, "Product B", 150.0, "2024-01-02"),
            (3, "Product C", 200.0, "2024-01-03")]
    return readers.inline_rows(spark, rows, PRODUCTS)


@pytest.fixture()
def changes(spark):
    rows = [(1, "Product A Updated", 110.0, "2024-01-01"), (4, "Product D", 250.0, "2024-01-04")]
    return readers.inline_rows(spark, rows, PRODUCTS)


def prices(df):
    return {r["id"]: r["price"] for r in df.collect()}


def test_inline_rows_are_nullable(products):
    assert all(f.nullable for f in products.schema.fields)
    assert products.count() == 3


def test_file_type():
    assert readers.file_type("x/y.CSV?sig=a.parquet") == "csv"
    assert readers.file_type("t.Parquet") == "parquet"
    with pytest.raises(ValueError):
        readers.file_type("t.json")


def test_sql_keeps_types_when_empty(spark, products):
    empty = readers.run_sql(spark, "SELECT id, price FROM {p} WHERE id > 9", p=products)
    assert empty.count() == 0
    assert [f.dataType.simpleString() for f in empty.schema.fields] == ["int", "double"]


def test_upsert(spark, products, changes):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(products, "products_t", root)
    upsert.upsert_table(spark, "products_t", changes, ["id"], root)
    assert prices(spark.table("products_t")) == {1: 110.0, 2: 150.0, 3: 200.0, 4: 250.0}
    assert spark.table("products_t").columns == list(PRODUCTS)
    lines = writers.history(spark, root).orderBy("version").collect()
    assert [(r["operation"], r["rows_in"], r["rows_out"]) for r in lines] == [("overwrite", 3, 3), ("merge", 2, 4)]


def test_upsert_refuses_duplicate_keys(spark, products, changes):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(products, "products_d", root)
    with pytest.raises(upsert.DuplicateKeys):
        upsert.upsert_table(spark, "products_d", changes.union(changes), ["id"], root)
    assert spark.table("products_d").count() == 3


def test_upsert_null_keys_never_match(spark, products, changes):
    blank = changes.withColumn("id", F.lit(None).cast("int"))
    target = products.union(blank)
    assert upsert.check_unique(blank, ["id"]) == 2
    assert upsert.upserted(target, blank, ["id"]).count() == 7


def test_versions_expire_but_the_live_folder_stays(spark, products):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(products, "products_v", root)
    writers.write_table(products, "products_v", root, "append")
    assert writers.expire_versions(spark, root, 0) == []
    assert spark.table("products_v").count() == 6
    writers.write_table(products.select("id"), "products_v", root)
    assert spark.table("products_v").columns == ["id"]
    assert writers.expire_versions(spark, root, 3600) == []
    removed = writers.expire_versions(spark, root, 0)
    assert len(removed) == 1 and removed[0].endswith("version=0")
    assert spark.table("products_v").count() == 3


def test_verified_append(spark, products):
    root = scratch.fresh_path(spark, "t")
    assert writers.verified_write(products, "products_a", root)[1]
    back, same = writers.verified_write(products, "products_a", root, "append")
    assert same and back.count() == 6


def test_partition_pruning(spark, products):
    path = scratch.fresh_path(spark, "p")
    writers.write_files(products.withColumn("year", F.lit(2024)).withColumn("month", F.col("id")), path,
                        partition_by=["year", "month"])
    plan = spark.read.parquet(path).filter("month = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_incremental_copy_moves_the_mark(spark, products):
    root = scratch.fresh_path(spark, "i")
    assert copyjobs.incremental_copy(products.filter("id < 3"), "id", root) == 2
    assert copyjobs.incremental_copy(products, "id", root) == 1
    assert copyjobs.incremental_copy(products, "id", root) == 0
    assert copyjobs.read_mark(spark, root, "int") == "3"
    assert prices(copyjobs.copied_rows(spark, root)) == prices(products)


def test_mark_orders_numbers_as_numbers(spark):
    root = scratch.fresh_path(spark, "i")
    copyjobs.incremental_copy(spark.range(9, 10), "id", root)
    copyjobs.incremental_copy(spark.range(9, 12), "id", root)
    assert copyjobs.read_mark(spark, root, "bigint") == "11"


def test_select_files_by_time(spark, products):
    path = scratch.fresh_path(spark, "f")
    writers.write_files(products, path)
    assert readers.select_files(spark, path, schema=products.schema, modified_before="2020-01-01T00:00:00").count() == 0
    assert readers.select_files(spark, path, schema=products.schema, modified_after="2020-01-01T00:00:00").count() == 3


def test_bad_rows(spark):
    rows = readers.inline_rows(spark, [("1", "2024-01-01"), ("x", "2024-01-02"), (None, "never")],
                               {"a": "string", "b": "string"})
    good, bad = copyjobs.split_incompatible(rows, {"a": "int", "b": "date"})
    assert good.collect() == [(1, dt.date(2024, 1, 1))]
    assert bad.count() == 2


def test_scratch_follows_the_setting(spark):
    assert scratch.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/tarnlake/x-")
    assert scratch.fresh_path(spark, "x") != scratch.fresh_path(spark, "x")


def test_compaction_spreads_a_hot_key(spark):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(spark.range(9000).selectExpr("IF(id % 3 = 0, id, 7) AS k", "'same' AS t"), "hot_t", root)
    laid_out = writers.compact(spark.table("hot_t"), ["k"], files=6)
    sizes = [r["n"] for r in laid_out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3000
    assert laid_out.columns == ["k", "t"]


def test_compaction_sorts_a_file_at_a_time(spark):
    """A task sorts what it writes, so that a file is far smaller than the memory of a task."""
    root = scratch.fresh_path(spark, "t")
    writers.write_table(spark.range(9000).selectExpr("id % 100 AS k", "id AS v"), "large_t", root)
    held = sizing.scanned_bytes(spark.table("large_t"))
    laid_out = writers.compact(spark.table("large_t"), ["k"], file_bytes=held // 5)
    assert laid_out.rdd.getNumPartitions() in (5, 6) and laid_out.count() == 9000
    assert writers.FILE_BYTES <= 64 * 2**20
    plan = laid_out._jdf.queryExecution().optimizedPlan().toString()
    assert "__tie" not in plan[:plan.index("RepartitionByExpression")]


def test_partitioned_upsert_with_moving_rows(spark):
    """The partition column is no key: a row may move to another partition."""
    root = scratch.fresh_path(spark, "t")
    rows = spark.range(10).selectExpr("id", "id * 1.0D AS v", "id % 2 AS part")
    writers.write_table(rows, "moving", root, partition_by=["part"])
    upsert.upsert_table(spark, "moving", spark.range(2).selectExpr("id", "9.0D AS v", "5L AS part"), ["id"], root)
    got = {r["id"]: (r["v"], r["part"]) for r in spark.table("moving").collect()}
    assert len(got) == 10 and got[0] == (9.0, 5) and got[1] == (9.0, 5) and got[2] == (2.0, 0)


def test_failed_write_is_passed_over(spark, products):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(products, "products_f", root)
    writers.write_files(products, f"{root}/version=1")
    writers.write_table(products.limit(1), "products_f", root)
    assert spark.table("products_f").count() == 1
    assert writers.location(spark, "products_f").endswith("version=2")


def test_expiry_passes_over_failed_writes_and_removes_them(spark, products):
    root = scratch.fresh_path(spark, "t")
    writers.write_table(products, "products_x", root)
    writers.write_files(products, f"{root}/version=1")
    writers.write_table(products.limit(1), "products_x", root)
    assert writers.expire_versions(spark, root, 3600) == []
    removed = [p.rsplit("/", 1)[1] for p in writers.expire_versions(spark, root, -1)]
    assert removed == ["version=0", "version=1"]
    assert spark.table("products_x").count() == 1


def test_partitioned_upsert_keeps_rows_of_a_null_partition(spark):
    root = scratch.fresh_path(spark, "t")
    shape = {"id": "int", "v": "string", "part": "string"}
    writers.write_table(readers.inline_rows(spark, [(1, "x", None), (2, "x", "p"), (3, "x", None)], shape),
                        "null_parts", root, partition_by=["part"])
    upsert.upsert_table(spark, "null_parts", readers.inline_rows(spark, [(9, "new", None)], shape),
                        ["id", "part"], root)
    got = sorted((r["id"], r["v"], r["part"]) for r in spark.table("null_parts").collect())
    assert got == [(1, "x", None), (2, "x", "p"), (3, "x", None), (9, "new", None)]


def test_marks_that_look_alike_keep_their_own_batches(spark):
    root = scratch.fresh_path(spark, "i")
    seen = []
    for mark in ("a b", "a-b", "a.b", "b", "c" * 200, "d"):
        seen.append((mark,))
        assert copyjobs.incremental_copy(readers.inline_rows(spark, seen, {"mark": "string"}), "mark", root) == 1
    assert sorted(r["mark"] for r in copyjobs.copied_rows(spark, root).collect()) == sorted(m for m, in seen)


def test_empty_writes_are_counted(spark, products):
    assert writers.write_files(products.filter("id > 9"), scratch.fresh_path(spark, "e")).rows == 0


class _Session:
    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def get(self, key, default):
        return default


def test_only_a_local_session_gets_a_temporary_folder():
    root = scratch.shared_root(_Session("local[2]"))
    assert root == scratch.shared_root(_Session("local[2]"))
    with pytest.raises(RuntimeError):
        scratch.shared_root(_Session("yarn"))


def test_partition_discovery_below_a_root(spark, products):
    path = scratch.fresh_path(spark, "d")
    writers.write_files(products.withColumn("year", F.col("id") + 2020), path, partition_by=["year"])
    found = readers.select_files(spark, f"{path}/year=202[12]", partition_root=path)
    assert sorted(r["year"] for r in found.collect()) == [2021, 2022]


def test_scan_of_a_named_table(spark, products):
    done = writers.write_table(products, "products_s", scratch.fresh_path(spark, "s"))
    assert readers.scan_table(spark, "products_s").count() == done.rows == 3 and done.seconds > 0
    assert readers.scan_path(spark, done.path).columns == list(PRODUCTS)


def test_partitioned_upsert_keeps_rows_beside_an_empty_partition_value(spark):
    root = scratch.fresh_path(spark, "t")
    shape = {"id": "int", "v": "string", "part": "string"}
    rows = [(1, "x", None), (2, "x", "p"), (3, "x", None), (4, "x", ""), (5, "x", "a:b'c%\\d e+f")]
    writers.write_table(readers.inline_rows(spark, rows, shape), "blank_parts", root, partition_by=["part"])
    upsert.upsert_table(spark, "blank_parts", readers.inline_rows(
        spark, [(9, "new", ""), (5, "new", "a:b'c%\\d e+f"), (7, "new", "01")], shape), ["id", "part"], root)
    got = sorted((r["id"], r["v"], r["part"]) for r in spark.table("blank_parts").collect())
    assert got == [(1, "x", None), (2, "x", "p"), (3, "x", None), (4, "x", None), (5, "new", "a:b'c%\\d e+f"),
                   (7, "new", "01"), (9, "new", None)]
    # Untouched partitions stay where they were, and no folder is written into.
    assert spark.read.parquet(f"{root}/version=0").count() == 5
    assert spark.read.parquet(f"{root}/parts=1").count() == 6


def test_incremental_copy_of_null_equal_and_late_marks(spark):
    """The rows of the third run were there from the second on: without a change value, and equal to the mark."""
    shape = {"id": "int", "changed": "int"}
    root = scratch.fresh_path(spark, "i")
    runs = [[(1, 5), (2, None)], [(1, 5), (2, None), (3, None), (4, 5), (5, 4)], [(1, 5), (2, None), (3, None), (4, 5), (5, 4), (6, 5), (6, 5)]]
    counts = [copyjobs.incremental_copy(readers.inline_rows(spark, r, shape), "changed", root, ["id"], F.lit(2)) for r in runs[:2]]
    assert counts == [2, 3]
    assert copyjobs.incremental_copy(readers.inline_rows(spark, runs[2], shape), "changed", root) == 2
    assert copyjobs.incremental_copy(readers.inline_rows(spark, runs[2], shape), "changed", root) == 0
    got = sorted(((r["id"], r["changed"]) for r in copyjobs.copied_rows(spark, root).collect()), key=str)
    assert got == sorted(runs[2], key=str)


def test_incremental_copy_from_marks_that_are_null(spark):
    shape = {"id": "int", "changed": "string"}
    root = scratch.fresh_path(spark, "i")
    assert copyjobs.incremental_copy(readers.inline_rows(spark, [], shape), "changed", root) == 0
    assert copyjobs.incremental_copy(readers.inline_rows(spark, [(1, None)], shape), "changed", root) == 1
    assert copyjobs.incremental_copy(readers.inline_rows(spark, [(1, None), (2, None), (3, "a")], shape), "changed", root) == 2
    assert copyjobs.copied_rows(spark, root).count() == 3


def test_a_batch_without_its_mark_is_written_again(spark):
    shape = {"id": "int", "changed": "int"}
    root = scratch.fresh_path(spark, "i")
    rows = readers.inline_rows(spark, [(1, 1), (2, 2), (3, 2)], shape)
    copyjobs.incremental_copy(rows.filter("id < 3"), "changed", root)
    # A run that ended between its rows and its mark.
    rows.filter("id = 3").write.parquet(f"{root}/rows/batch=1")
    assert copyjobs.incremental_copy(rows, "changed", root) == 1
    assert sorted(r["id"] for r in copyjobs.copied_rows(spark, root).collect()) == [1, 2, 3]


def test_readers_never_miss_a_partitioned_table_while_it_is_overwritten(spark):
    root, name = scratch.fresh_path(spark, "t"), "always_there"

    def write(n):
        rows = spark.range(40).selectExpr(f"id + {n} AS id", f"CAST((id + {n}) % 5 AS string) AS part")
        writers.write_table(rows if n % 2 else rows.filter("part <> '3'"), name, root, partition_by=["part"])

    write(1)
    stop, problems, seen = threading.Event(), [], set()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.table(name).count())
            except Exception as problem:  # noqa: BLE001
                problems.append(str(problem)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in (2, 3, 4, 5):
            write(n)
    finally:
        stop.set()
        reader.join()
    assert not problems and 0 not in seen
    assert spark.table(name).agg(F.min("id"), F.max("id"), F.count("*")).first()[:] == (5, 44, 40)
    assert spark.table(name).schema["part"].dataType.simpleString() == "string"


def test_columns_are_added_in_place(spark):
    root = scratch.fresh_path(spark, "t")
    for name, by in (("grown", []), ("grown_parts", ["part"])):
        rows = spark.range(6).selectExpr("id", "id % 2 AS part")
        writers.write_table(rows, name, f"{root}/{name}", partition_by=by)
        wider = spark.range(4).selectExpr("id", "id % 2 AS part", "'x' AS more") if not by else \
            spark.range(4).selectExpr("id", "'x' AS more", "id % 2 AS part")
        writers.write_table(wider, name, f"{root}/{name}", partition_by=by)
        assert spark.table(name).columns == wider.columns
        assert spark.table(name).filter("more = 'x'").count() == 4 == spark.table(name).count()


KEYED = {"id": "int", "kind": "string", "v": "string"}


def keyed_table(spark, name, rows, cells=8):
    root = scratch.fresh_path(spark, name)
    keyed.create_table(readers.inline_rows(spark, rows, KEYED), name, root, ["id", "kind"], cells)
    return root


def keyed_rows(spark, name):
    return sorted((tuple(r) for r in keyed.rows(spark, name).collect()), key=str)


def test_keyed_upsert_writes_only_what_it_hits(spark):
    rows = [(i, k, "old") for i in range(100) for k in "ab"]
    root = keyed_table(spark, "keyed_t", rows)
    changes = [(41, "a", "new"), (42, "b", "new"), (41, "c", "added"), (500, "a", "added"), (None, "a", "added"), (7, None, "added")]
    done = keyed.upsert(spark, "keyed_t", readers.inline_rows(spark, changes, KEYED), ["id", "kind"], root)
    assert done.held == 8 and 1 <= done.rewritten <= 2 and done.added == 1
    wanted = {(i, k): v for i, k, v in rows} | {(i, k): v for i, k, v in changes}
    assert keyed_rows(spark, "keyed_t") == sorted(((i, k, v) for (i, k), v in wanted.items()), key=str)
    # Null keys match nothing, and cells that were added are found again.
    again = readers.inline_rows(spark, [(None, "a", "twice"), (500, "a", "newer"), (3, "a", "newer")], KEYED)
    done = keyed.upsert(spark, "keyed_t", again, ["id", "kind"], root)
    assert done.held == 9 and done.rewritten == 2
    got = keyed_rows(spark, "keyed_t")
    assert len(got) == len(wanted) + 1 and (500, "a", "newer") in got and (None, "a", "twice") in got and (None, "a", "added") in got


def test_keyed_upsert_oddities(spark):
    rows = [(1, "a", "x"), (1, "a", "y"), (2, "a", None), (None, None, "x")]
    root = keyed_table(spark, "keyed_odd", rows, cells=3)
    source = readers.inline_rows(spark, [(1, "a", "one")], KEYED)
    with pytest.raises(upsert.DuplicateKeys):
        keyed.upsert(spark, "keyed_odd", source.union(source), ["id", "kind"], root)
    keyed.upsert(spark, "keyed_odd", source, ["id", "kind"], root)
    assert keyed_rows(spark, "keyed_odd") == sorted([(1, "a", "one"), (2, "a", None), (None, None, "x")], key=str)
    done = keyed.upsert(spark, "keyed_odd", source.filter("false"), ["id", "kind"], root)
    assert (done.rewritten, done.added, done.rows) == (0, 0, 0) and len(keyed_rows(spark, "keyed_odd")) == 3
    empty = keyed_table(spark, "keyed_empty", [])
    keyed.upsert(spark, "keyed_empty", source, ["id", "kind"], empty)
    assert keyed_rows(spark, "keyed_empty") == [(1, "a", "one")]


def test_folders_of_partitions_expire(spark):
    root = keyed_table(spark, "keyed_old", [(i, "a", "x") for i in range(20)], cells=2)
    for v in ("y", "z"):
        keyed.upsert(spark, "keyed_old", readers.inline_rows(spark, [(3, "a", v)], KEYED), ["id", "kind"], root)
    assert writers.expire_versions(spark, root, 0) == []
    removed = writers.expire_versions(spark, root, -1, name="keyed_old")
    assert [p.rsplit("/", 1)[1] for p in removed] == ["parts=1"]
    assert sorted(r[2] for r in keyed_rows(spark, "keyed_old")) == ["x"] * 19 + ["z"]
    keyed.create_table(readers.inline_rows(spark, [(1, "a", "x")], KEYED), "keyed_old", root, ["id", "kind"], 1)
    removed = writers.expire_versions(spark, root, -1, name="keyed_old")
    assert [p.rsplit("/", 1)[1] for p in removed] == ["parts=2", "version=0"]
    assert keyed_rows(spark, "keyed_old") == [(1, "a", "x")]
