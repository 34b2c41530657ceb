import json
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import predicates, scalars
from tarnlake.operators import (
    aggregates,
    catalog,
    entities,
    joins,
    metrics,
    ordered,
    quality,
    regression,
    runs,
    sets,
    textrules,
    topk,
    transform,
)
from tarnlake import sizing
from tarnlake.sizing import broadcast_if_small
from tarnlake.sources.readers import inline_rows


@pytest.fixture(scope="module")
def sales(spark):
    rows = [("2024-01-01", "North", "Product A", 1000, 100), ("2024-01-01", "South", "Product A", 800, 80),
            ("2024-01-02", "North", "Product B", 1200, 120), ("2024-01-02", "South", "Product B", 900, 90),
            ("2024-01-03", "East", "Product A", 1100, 110), ("2024-01-03", "West", "Product C", 700, 70)]
    schema = {"date": "string", "region": "string", "product": "string", "revenue": "int", "quantity": "int"}
    return inline_rows(spark, rows, schema).withColumn("date", scalars.parse_date(F.col("date")))


def value(spark, column, text=None):
    frame = spark.range(1).withColumn("t", F.lit(text))
    return frame.select(column).first()[0]


def test_sales_reports(sales):
    one = F.lit(1)
    by_region = aggregates.revenue_report(sales, "region", F.col("revenue"), F.col("quantity"), one).collect()
    assert [tuple(r) for r in by_region] == [
        ("North", 2200, 220, 2), ("South", 1700, 170, 2), ("East", 1100, 110, 1), ("West", 700, 70, 1)]
    by_product = aggregates.revenue_average(sales, "product", F.col("revenue"), one).collect()
    assert [(r[0], r[1]) for r in by_product] == [("Product A", 2900), ("Product B", 2100), ("Product C", 700)]


def test_sales_windows(sales):
    totals = ordered.running_total(sales, ["region"], "date", "revenue", "total")
    assert [r[0] for r in totals.filter("region = 'North'").orderBy("date").select("total").collect()] == [1000, 2200]
    ranks = ordered.rank_rows(sales, ["region"], ordered.Order("revenue", True), "rank")
    assert {(r["region"], r["revenue"]): r["rank"] for r in ranks.collect()}["South", 900] == 1


def test_etl(spark):
    rows = [("2024-01-01", "Product A", 100, 25.5), ("2024-01-02", "Product C", 80, 45.0), ("bad", "x", 1, 1.0)]
    out = transform.sales_etl(
        inline_rows(spark, rows, {"date": "string", "product": "string", "quantity": "int", "price": "double"}),
        "date", "quantity", "price").collect()
    assert [r["revenue"] for r in out] == [2550.0, 3600.0, 1.0]
    assert (out[0]["year"], out[0]["month"], out[2]["date"]) == (2024, 1, None)


def test_transform_stamps_the_rows(sales):
    out = transform.transform(sales, ["region"], "revenue > 1000")
    assert out.columns == ["region", "processed_date"] and out.count() == 2
    assert transform.transform(sales).count() == 6


@pytest.mark.parametrize("seconds, label", [(0, "0s"), (59.9, "59s"), (60, "1m 0s"), (3599, "59m 59s"), (3600, "1h 0m"),
                                            (9000, "2h 30m"), (None, "N/A")])
def test_duration_label(spark, seconds, label):
    assert value(spark, scalars.duration_label(F.lit(seconds).cast("double"))) == label


def test_run_duration(spark):
    def at(text):
        return scalars.iso_timestamp(F.lit(text))
    start, now = at("2024-01-01T00:00:00Z"), at("2024-01-01T00:02:05Z")
    assert value(spark, scalars.run_duration(start, at("2024-01-01T01:00:01.5Z"), F.lit("Failed"), now)) == "60m 1s"
    assert value(spark, scalars.run_duration(start, at(None), F.lit("InProgress"), now)) == "2m 5s"
    assert value(spark, scalars.run_duration(start, at("?"), F.lit("Failed"), now)) == "N/A"


@pytest.mark.parametrize("text, rows", [
    ("plain", [(None, "plain", "")]),
    ('{"code":"E1","message":"m"}', [("E1", "m", "")]),
    ('{"errorCode":"","x":1}', [("Unknown", "No message", "")]),
    ('[{"errorCode":"E2","errorMessage":"n","source":"s"},"two"]', [("E2", "n", "s"), (None, "two", "")]),
    ("[broken", [(None, "[broken", "")]),
    ("{broken", [(None, "{broken", "")]),
    ("", []), (None, []), ("[]", []),
])
def test_error_rows(spark, text, rows):
    frame = inline_rows(spark, [(1, text)], {"id": "int", "errors": "string"})
    assert [(r["code"], r["message"], r["source"]) for r in runs.run_errors(frame).collect()] == rows


def test_error_field(spark):
    def read(text, key="errorCode"):
        return value(spark, scalars.error_field(scalars.json_object(F.col("t")), key, "Unknown"), text)
    assert read('{"errorCode":"C1"}') == "C1"
    assert read('{"a":1}') == "Unknown"
    assert read("not json") is None


def test_text_helpers(spark):
    assert value(spark, scalars.literal_count(F.col("t"), "aa"), "aaaaa") == 2
    assert value(spark, scalars.truncate_marked(F.col("t"), 3), "abcdef") == "abc..."
    assert value(spark, scalars.truncate_counted(F.col("t"), 4), "abcdef") == "abcd\n... [truncated, 2 chars omitted]"
    assert value(spark, scalars.display_number(F.lit(1234567.0))) == "1,234,567"
    assert value(spark, scalars.display_number(F.lit(1234.5))) == "1,234.50"
    assert value(spark, scalars.display_number(F.lit(None).cast("double"))) == ""
    assert value(spark, scalars.first_non_empty(F.lit(""), F.lit(None).cast("string"), F.lit("x"))) == "x"


@pytest.mark.parametrize("text, domain", [
    ("Explore lakehouse tables", "lakehouse"), ("Validate my notebook code", "notebook"),
    ("List all tables in lakehouse", "lakehouse"), ("Create a new PySpark notebook", "notebook"), ("hello", "unknown")])
def test_domain(spark, text, domain):
    assert value(spark, textrules.route(F.col("t")), text) == domain


@pytest.mark.parametrize("text, template", [
    ("Create ETL pipeline notebook", "etl"), ("Create machine learning notebook", "ml"),
    ("Create analytics notebook", "analytics"), ("Create streaming data notebook", "streaming"), ("hello", "basic")])
def test_template(spark, text, template):
    assert value(spark, textrules.first_class(F.col("t")), text) == template


@pytest.mark.parametrize("text, name", [
    ("Create notebook called 'Sales Analysis'", "Sales Analysis"), ('Create notebook named "ETL Pipeline"', "ETL Pipeline"),
    ("Create 'Test Notebook' notebook", "Test Notebook"), ("Create a notebook", None)])
def test_quoted_name(spark, text, name):
    assert value(spark, textrules.quoted_name(F.col("t")), text) == name


def test_flagged_snippet(spark):
    code = "a = spark.table('x')\nb = spark.table('y')\nc = a.join(b, 'id')\nrows = c.collect()"
    cells = inline_rows(spark, [(1, 0, code), (1, 1, "c.collect()")], {"doc": "int", "cell": "int", "code": "string"})
    found = textrules.rule_findings(cells, ["doc", "cell"], "code", textrules.PERFORMANCE_RULES)
    assert sorted((r["cell"], r["rule"]) for r in found.collect()) == [
        (0, "collect"), (0, "join_without_broadcast"), (1, "collect")]
    assert [tuple(r) for r in textrules.rule_scores(cells, "doc", "code").collect()] == [(1, 1, 1, 85, "excellent")]
    counts = textrules.operation_counts(cells, ["cell"], "code").orderBy("cell").collect()
    assert tuple(counts[0]) == (0, 2, 0, 0, 1, 3)


def test_code_cells(spark):
    book = ('{"cells":[{"cell_type":"markdown","source":["# t"]},{"cell_type":"code","source":["a\\n","b"]},'
            '{"type":"code","content":"[1, 2]x"},{"cell_type":"code","source":""}]}')
    frame = inline_rows(spark, [(1, book), (2, '{"content":' + book + "}"), (3, "junk"), (4, json.dumps({"content": book}))],
                        {"id": "int", "n": "string"})
    found = textrules.code_cells(frame, "id", "n")
    got = [tuple(r) for r in found.orderBy("id", "position").collect()]
    assert got == [(i, p, s) for i in (1, 2, 4) for p, s in ((1, "a\nb"), (2, "[1, 2]x"))]


def test_null_report_of_an_empty_table(spark):
    empty = inline_rows(spark, [], {"a": "int"})
    assert [tuple(r) for r in quality.null_report(empty).collect()] == [("a", 0, None)]
    assert tuple(quality.duplicate_rows(empty).first()) == (0, 0, 0)


def test_digest_tells_apart_shifted_values(spark):
    rows = inline_rows(spark, [("ab", "c"), ("a", "bc"), (None, "-"), ("-", None), ("1:a", ""), ("a", "bc")],
                       {"x": "string", "y": "string"})
    assert tuple(quality.duplicate_rows(rows, digest=True).first()) == (6, 5, 1)
    assert tuple(quality.duplicate_rows(rows).first()) == (6, 5, 1)


def test_unique_lookup(spark):
    names = inline_rows(spark, [("1", "Alpha"), ("2", "beta"), ("3", "BETA")], {"id": "string", "name": "string"})
    asked = inline_rows(spark, [("ALPHA",), ("beta",), ("gamma",), ("2",)], {"w": "string"})
    got = {r["w"]: (r["id"], r["status"]) for r in joins.unique_lookup(asked, "w", names, "id", "name").collect()}
    assert got == {"ALPHA": ("1", "ok"), "beta": (None, "ambiguous"), "gamma": (None, "missing"), "2": ("2", "ok")}


def test_same_named_keys_are_both_kept(spark):
    a = inline_rows(spark, [(1, "x")], {"id": "int", "l": "string"})
    assert joins.join_keeping_keys(a, a.withColumnRenamed("l", "r"), "id", "id").columns == ["id", "l", "right_id", "r"]


def test_broadcast_only_below_the_limit(spark):
    assert "broadcast" in broadcast_if_small(spark.range(10))._jdf.queryExecution().logical().toString()
    assert "broadcast" not in broadcast_if_small(spark.range(10**10))._jdf.queryExecution().logical().toString()


def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path):
    """Keys and few different values compress well; the driver would have to hold a hash table of all rows."""
    spark.range(0, 2_000_000, 1, 1).selectExpr("id", "id % 3 AS kind").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    assert sizing.estimated_bytes(dim) * sizing.FILE_EXPANSION < 200 * 2**20
    assert not sizing.is_small(dim) and sizing.is_small(dim.filter("id < 100000"))
    model = metrics.Model("f", {"f": spark.range(10).selectExpr("id AS k"), "d": dim},
                          [metrics.Relationship("f", "k", "d", "id")], {"N": metrics.Measure("count", "1")})
    totals = metrics.evaluate(model, ["N"], ["d.kind"])
    assert "broadcast" not in totals._jdf.queryExecution().logical().toString()
    assert sorted(r["N"] for r in totals.collect()) == [3, 3, 4]


def test_summary_is_settled_when_its_size_is_unknown(spark):
    small = spark.range(10**7).groupBy((F.col("id") % 3).alias("k")).count()
    settled = sizing.settled(small, limit_bytes=10**7)
    assert "parquet" in settled._jdf.queryExecution().toString().lower()
    assert "broadcast" in settled._jdf.queryExecution().logical().toString()
    assert settled.count() == 3


def test_reference_spellings(spark, sales):
    model = metrics.Model("sales", {"sales": sales, "Date": inline_rows(spark, [(1,)], {"Year": "int"})}, [])
    for text in ("'Date'[Year]", "Date[Year]", "Date.Year", "[Year]", " Year "):
        assert model.locate(text) == ("Date", "Year")
    with pytest.raises(ValueError):
        model.locate("[missing]")


@pytest.mark.parametrize("presum", [True, False])
def test_metric_paths_agree(spark, presum):
    fact = inline_rows(spark, [(1, 10.0), (1, 5.0), (2, None), (3, 7.0), (None, 1.0)], {"k": "int", "x": "double"})
    dim = inline_rows(spark, [(1, "a"), (2, "b")], {"id": "int", "name": "string"})
    shape = {"Total": metrics.Measure("sum", "x"), "Mean": metrics.Measure("avg", "x"),
             "Low": metrics.Measure("min", "x"), "N": metrics.Measure("count", "x")}
    model = metrics.Model("f", {"f": fact, "d": dim}, [metrics.Relationship("f", "k", "d", "id")], shape)
    got = metrics.evaluate(model, ["Total", "[Mean]", "Low"], ["d.name"], presum=presum).collect()
    assert {r["name"]: tuple(r)[1:] for r in got} == {"a": (15.0, 7.5, 5.0), None: (8.0, 4.0, 1.0)}
    total = metrics.evaluate(model, ["Total", "N"], filters={"d.name": ["a"]}, presum=presum).first()
    assert tuple(total) == (15.0, 2)


def test_two_dimensions_may_share_a_column_name(spark):
    fact = inline_rows(spark, [(1, 2, 10.0), (2, 1, 5.0)], {"a": "int", "b": "int", "x": "double"})
    first = inline_rows(spark, [(1, "p"), (2, "q")], {"id": "int", "name": "string"})
    links = [metrics.Relationship("f", "a", "one", "id"), metrics.Relationship("f", "b", "two", "id")]
    model = metrics.Model("f", {"f": fact, "one": first, "two": first}, links, {"T": metrics.Measure("sum", "x")})
    got = metrics.evaluate(model, ["T"], ["one.name", "two.name"], {"'two'[id]": ["2"]})
    assert got.columns == ["one.name", "two.name", "T"]
    assert [tuple(r) for r in got.collect()] == [("p", "q", 10.0)]


def test_caps(spark):
    assert [topk.checked_cap(n) for n in (1, 7, 100_000)] == [1, 7, 100_000]
    for wrong in (-5, 0, 100_001, 10**9):
        with pytest.raises(ValueError):
            topk.capped(spark.range(5), wrong)
    assert topk.read_columns(spark.range(3000), ["id"]).count() == 3000
    assert [r.id for r in topk.read_columns(spark.range(5), ["id"], 2, ["id"]).collect()] == [0, 1]


def test_newest_per_group_limits_before_the_shuffle(spark):
    frame = spark.range(100).selectExpr("id", "id % 2 AS g", "id AS t")
    newest = topk.newest_per_group(frame, "g", "t", "id", 3)
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in newest.collect()) == [94, 95, 96, 97, 98, 99]


def test_top_by_priority_is_stable(spark):
    rows = inline_rows(spark, [(6, 0, "a"), (8, 1, "b"), (8, 2, "c"), (7, 3, "d"), (6, 4, "e"), (9, 5, "f")],
                       {"p": "int", "s": "int", "n": "string"})
    assert [r["n"] for r in topk.top_by_priority(rows, "p", "s").collect()] == ["f", "b", "c", "d", "a"]


def test_gather_reports_failures(spark):
    got = sets.gather(spark, {"a": lambda: spark.range(2), "b": lambda: spark.read.parquet("/no/such/path")})
    assert got.rows.count() == 2 and got.errors.first()["source"] == "b"
    assert sets.gather(spark, {"b": lambda: spark.table("absent")}).rows is None


def test_filter_tree_and_dict_filter(sales):
    tree = {"op": "And", "nodes": [{"column": "region", "op": "Contains", "value": "th"},
                                   {"column": "revenue", "op": "Gt", "value": "900", "type": "BigInt"}]}
    assert sales.filter(predicates.tree_condition(tree)).count() == 2
    assert predicates.dict_filter(sales, {"revenue": ["800", "700"], "region": ["South"]}).count() == 1
    assert predicates.optional_equals(sales, region=None, product="Product A").count() == 3


def test_cohort(spark):
    person = inline_rows(spark, [(1, 2000), (2, 2000), (3, 1990)], {"id": "int", "born": "int"})
    visit = inline_rows(spark, [(1, "x", 5), (1, "y", 50), (2, "x", 50), (9, "x", 50)],
                        {"pid": "int", "kind": "string", "cost": "int"})
    born = {"node": "Leaf", "path": "person.born", "op": "Equal", "value": "2000", "type": "int"}
    kind = {"node": "Leaf", "path": "visit.kind", "op": "Equal", "value": "x"}
    cost = {"node": "Leaf", "path": "visit.cost", "op": "GreaterThan", "value": "10", "type": "int"}

    def ids(tree):
        found = entities.cohort({"person": person, "visit": visit}, {"person": "id", "visit": "pid"}, "person", tree)
        return sorted(r["entity_id"] for r in found.collect())

    assert ids({"node": "And", "children": [born]}) == [1, 2]
    assert ids({"node": "And", "children": [kind, cost]}) == [1, 2]
    assert ids({"node": "UnitAnd", "children": [kind, cost]}) == [2]
    assert ids({"node": "Not", "children": [{"node": "UnitAnd", "children": [kind, cost]}]}) == [1, 3]
    assert ids({"node": "Or", "children": [{"node": "Not", "children": [born]}, cost]}) == [1, 2, 3]


def test_composite_ids_do_not_collide(spark):
    rows = inline_rows(spark, [("a|b", "c"), ("a", "b|c"), ("a", None)], {"x": "string", "y": "string"})
    got = [r[0] for r in rows.select(entities.entity_key("x", "y")).collect()]
    assert got[0] != got[1] and got[2] is None


def test_regression_template(spark):
    rows = [(i, 1.0 + i, 2.0 + i, 3.0 + i, 5.0 * (1 + i)) for i in range(1, 41)]
    frame = inline_rows(spark, rows, {"id": "int", "f1": "double", "f2": "double", "f3": "double", "label": "double"})
    train, test = regression.random_parts(frame)
    scored = regression.predictions(regression.fit(train, ["f1", "f2", "f3"], "label"), test, "id", "label")
    assert scored.columns == ["id", "label", "prediction"]
    by_evaluator = regression.evaluate(scored, "label")
    assert by_evaluator["rmse"] < 1e-6 and by_evaluator["r2"] > 0.999999
    row = regression.scores(scored, "label").first()
    assert row["rmse"] == pytest.approx(by_evaluator["rmse"], abs=1e-9)
    assert row["r2"] == pytest.approx(by_evaluator["r2"], abs=1e-9)


def test_catalog(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("Listed")
    spark.range(2).write.mode("overwrite").format("json").saveAsTable("foreign_format")
    spark.range(2).createOrReplaceTempView("a_view")
    found = catalog.catalog_tables(spark)
    assert "listed" in {n.lower() for n in found} and "a_view" in found and "foreign_format" not in found
    assert set(catalog.catalog_tables(spark, database="no_such_database")) == set()
    one = catalog.catalog_tables(spark, "LISTED")
    assert [tuple(r) for r in catalog.explore(spark, one).drop("table_name").collect()] == [
        ("id", 1, "bigint", True, 3, 0, 0.0)]
    nothing = catalog.summary(catalog.list_columns(spark, {})).first()
    assert tuple(nothing) == (0, 0, 0.0, 0)


def test_state_counts(spark):
    rows = inline_rows(spark, [("b",), (None,), ("a",), ("b",)], {"s": "string"})
    assert [tuple(r) for r in aggregates.state_counts(rows, "s").collect()] == [("Unknown", 1), ("a", 1), ("b", 2)]


def test_refresh_times_are_cut(spark):
    assert value(spark, runs.clean_time(F.lit("2024-01-01T10:00:00.123Z"))) == "2024-01-01 10:00:00.12"
    assert value(spark, runs.clean_time(F.lit("2024-01-01T10:00:00Z"))) == "2024-01-01 10:00:00 UT"
    assert dt.datetime(2024, 1, 1) == value(spark, scalars.iso_timestamp(F.lit("2024-01-01T00:00:00Z")))


def test_spans_before_zero(spark):
    for seconds, minutes, label in ((-5.0, "-1m 55s", "-5s"), (-0.5, "0m 0s", "0s"), (125.9, "2m 5s", "2m 5s")):
        assert value(spark, scalars.minutes_seconds(F.lit(seconds))) == minutes
        assert value(spark, scalars.duration_label(F.lit(seconds))) == label


def test_digests_tell_arrays_apart(spark):
    rows = spark.sql("SELECT * FROM VALUES (array('a, b')), (array('a', 'b')), (array('a', 'b')) AS t(x)")
    for digest in (False, True):
        assert quality.duplicate_rows(rows, digest=digest).first()["duplicate_rows"] == 1


def test_shares_of_the_test_part(spark):
    rows = spark.range(10_000)
    for share, least, most in ((0.0, 0, 0), (0.2, 1850, 2150), (1.0, 10_000, 10_000)):
        assert least <= rows.filter(regression.in_test_part(F.col("id"), share=share)).count() <= most


def test_all_groups_come_back_without_a_cap(spark):
    fact = spark.range(9000).selectExpr("id % 3000 AS g", "CAST(id AS DECIMAL(18,0)) AS x")
    model = metrics.Model("f", {"f": fact}, [], {"T": metrics.Measure("sum", "x")})
    assert metrics.evaluate(model, ["T"], ["g"]).count() == 3000
    assert [r["g"] for r in metrics.evaluate(model, ["T"], ["g"], max_rows=3).collect()] == [0, 1, 2]
    with pytest.raises(ValueError):
        metrics.evaluate(model, ["T"], ["g"], max_rows=200_000)


def test_a_source_that_fails_while_being_read_is_reported(spark):
    broken = lambda: spark.range(3).selectExpr("CAST(raise_error('gone') AS BIGINT) AS id")
    got = sets.gather(spark, {"a": lambda: spark.range(2), "b": broken}, fetch=True)
    assert [r["id"] for r in got.rows.orderBy("id").collect()] == [0, 1]
    assert [r["source"] for r in got.errors.collect()] == ["b"]


def test_newest_per_group_with_salts(spark):
    frame = spark.range(0, 3000, 1, 12).selectExpr("id", "IF(id % 3 > 0, 0, id % 7) AS g", "id * 7919 % 1013 AS t")
    plain = {tuple(r) for r in topk.newest_per_group(frame, "g", "t", "id", 5, salts=1).collect()}
    assert {tuple(r) for r in topk.newest_per_group(frame, "g", "t", "id", 5, salts=4).collect()} == plain
    assert len(plain) == 35


def test_names_of_submitters_come_from_the_directory(spark):
    submitter = "struct<displayName:string,userPrincipalName:string,mail:string,name:string,id:string,type:string>"
    rows = [(1, (None, "u@x", None, None, "7", "User")), (2, ("App", None, None, None, "7", "Service")),
            (3, ("Own", None, None, None, "9", "User")), (4, ("Own", None, None, "n", "8", "User")), (5, None)]
    frame = spark.createDataFrame(rows, f"id int, submitter {submitter}")
    users = spark.createDataFrame([("7", "Seven", None, "m"), ("8", None, None, None)],
                                  "id string, displayName string, userPrincipalName string, mail string")
    named = runs.with_user_names(frame, users).select("id", runs.submitter_name().alias("by")).orderBy("id")
    assert [r["by"] for r in named.collect()] == ["Seven", "App", "Own", "n", None]


def test_samples_are_the_same_in_any_layout(spark):
    frame = spark.range(500).selectExpr("id", "IF(id % 9 = 0, NULL, id * 1.5D) AS x", "array(id) AS a")
    one, other = (quality.sampled(frame.repartition(n), 10, ["id"]).orderBy("column_name").collect() for n in (2, 7))
    assert one == other and [r["column_name"] for r in one] == ["a", "id", "x"]
    ids = json.loads(one[1]["sample"])
    assert len(set(ids)) == 10 and json.loads(one[0]["sample"]) == [f"[{i}]" for i in ids]
    assert quality.sampled(frame.limit(0)).first()["sample"] == "[]"


def test_derived_measures(spark):
    fact = spark.createDataFrame([(1, 5.0, "a"), (1, 3.0, "b"), (2, None, "a"), (None, 1.0, None), (2, 0.0, "a"), (3, None, None)],
                                 "k int, x double, who string")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "k int, name string")
    shape = {"Sum": metrics.Measure("sum", "x"), "N": metrics.Measure("count", "x"), "Who": metrics.Measure("distinct", "who"),
             "Mean": metrics.Ratio("Sum", "N"), "Per Head": metrics.Ratio("[Sum]", "[Who]")}
    model = metrics.Model("f", {"f": fact, "d": dim}, [metrics.Relationship("f", "k", "d", "k")], shape)
    for presum in (True, False, None):
        got = metrics.evaluate(model, ["Mean", "[Who]", "Per Head"], ["d.name"], presum=presum, order_by=["name"]).collect()
        assert [tuple(r) for r in got] == [(None, 1.0, 0, None), ("one", 4.0, 2, 4.0), ("three", None, 0, None), ("two", 0.0, 1, 0.0)]
        assert tuple(metrics.evaluate(model, ["Who", "Mean"], presum=presum).first()) == (2, 2.25)
        assert metrics.evaluate(model, ["Who"], ["name"], {"d[name]": ["one", "two"]}, presum=presum).count() == 2
    with pytest.raises(ValueError):
        metrics.evaluate(metrics.Model("f", {"f": fact}, [], {"A": metrics.Ratio("A", "A")}), ["A"])
