"""Rule scans and routing over documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.predicates import contains_any_case
from tarnlake.functions.scalars import truncate_counted, truncate_marked
from tarnlake.operators import textrules
from tarnlake.operators.topk import top_by_priority
from tarnlake.operators.textrules import OPTIMISATION, Rule
from tarnlake.plans.registry import query
from tarnlake.sizing import spread_if_small
from tarnlake.sources.readers import table

# Every document gives two code cells: its text followed by code that depends on language or source.
FIRST_CELL = """text || CASE lang
  WHEN 'en' THEN ' a = spark.read.parquet(p).join(b, key).collect() for row in df.collect()'
  WHEN 'fr' THEN ' df.write.saveAsTable(t) lakehouse df.filter(x).show() df.a df.b df.c'
  WHEN 'de' THEN ' sc.rdd.map(f) spark.read.a spark.read.b spark.read.c spark.read.d'
  ELSE ' from pyspark.sql import SparkSession; SparkSession.builder.getOrCreate()' END"""
SECOND_CELL = """CASE WHEN source < 'src13' THEN ' url = JDBC:x workspace platform_helpers df.toPandas()'
  WHEN source < 'src16' THEN ' x.withColumn(a).select(b).filter(c).count() createDataFrame(r)'
  WHEN source < 'src3' THEN ' df.write.partitionBy(k).format("delta").saveAsTable(t) hdfs://a'
  ELSE ' spark.sql("USE db") a.join(broadcast(b)) s3://c df.cache() df.x df.y df.z' END || text"""
CELLS_SQL = f"""
cells AS (SELECT doc_id, 1 AS cell, {FIRST_CELL} AS code FROM documents
          UNION ALL SELECT doc_id, 2, {SECOND_CELL} FROM documents)
"""


def code_texts(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, cell, code): one pass over the documents."""
    cells = f"array(struct(1 AS cell, {FIRST_CELL} AS code), struct(2 AS cell, {SECOND_CELL} AS code))"
    return spread_if_small(table(spark, sf, "documents")).selectExpr("doc_id", f"inline({cells})")


def _has(*patterns: str) -> str:
    return "(" + " OR ".join(f"contains(code, '{p}')" for p in patterns) + ")"


def _times(pattern: str) -> str:
    return f"(length(code) - length(replace(code, '{pattern}', ''))) // {len(pattern)}"


SCAN_SQL = {
    ("own_session", "issue"): _has("SparkSession.builder"),
    ("platform_utilities", "suggestion"): f"{_has('lakehouse', 'workspace')} AND NOT {_has('platform_helpers')}",
    ("table_format", "suggestion"): f"""{_has('.saveAsTable(')} AND NOT {_has('format("delta")')}""",
    ("jdbc_connector", "suggestion"): "contains(lower(code), 'jdbc')",
    ("collect", "warning"): _has(".collect()"),
    ("rdd_use", "warning"): f"{_has('rdd.')} AND NOT {_has('parallelize')}",
    ("reads_without_cache", "optimisation"): f"{_times('spark.read')} > 3 AND NOT {_has('.cache()')}",
    ("join_without_broadcast", "optimisation"): f"{_has('.join(')} AND NOT {_has('broadcast')}",
    ("write_without_partitions", "optimisation"): f"{_has('.write.')} AND NOT {_has('partitionBy')}",
}
STYLE_SQL = {
    ("no_imports", "warning"): f"NOT {_has('from pyspark', 'import pyspark')}",
    ("collect_call", "warning"): _has(".collect()"),
    ("to_pandas", "warning"): _has(".toPandas()"),
    ("loop_over_collect", "warning"): _has("for row in df.collect()"),
    ("reuse_without_cache", "suggestion"): f"{_times('df.')} > 3 AND NOT {_has('.cache()', '.persist()')}",
    ("frame_without_schema", "suggestion"): f"{_has('createDataFrame')} AND NOT {_has('StructType')}",
    ("filter_without_nulls", "suggestion"): f"{_has('.filter(')} AND NOT {_has('isNull', 'isNotNull')}",
    ("write_without_partition_by", "suggestion"): f"{_has('.write.')} AND NOT {_has('partitionBy')}",
    ("write_without_format", "suggestion"): f"""{_has('.write.')} AND NOT {_has('format("delta")')}""",
    ("explicit_use", "warning"): _has('spark.sql("USE'),
    ("direct_paths", "warning"): _has("hdfs://", "s3://"),
}


def _findings_sql(rules: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT doc_id, CAST(cell AS BIGINT) AS cell, '{name}' AS rule, '{kind}' AS kind FROM cells WHERE {test}"
        for (name, kind), test in rules.items())


def _findings(spark: SparkSession, sf: str, *rule_sets) -> DataFrame:
    cells = code_texts(spark, sf).withColumn("cell", F.col("cell").cast("bigint"))
    return textrules.rule_findings(cells, ["doc_id", "cell"], "code", [r for rs in rule_sets for r in rs])


@query(f"WITH {CELLS_SQL} {_findings_sql(SCAN_SQL)}")
def rule_findings(spark: SparkSession, sf: str) -> DataFrame:
    return _findings(spark, sf, textrules.PLATFORM_RULES, textrules.PERFORMANCE_RULES)


@query(f"WITH {CELLS_SQL} {_findings_sql(STYLE_SQL)}")
def style_findings(spark: SparkSession, sf: str) -> DataFrame:
    return _findings(spark, sf, textrules.STYLE_RULES, textrules.USAGE_RULES)


@query(f"""
WITH {CELLS_SQL}, found AS ({_findings_sql(SCAN_SQL)}),
n AS (SELECT doc_id, count(DISTINCT CASE WHEN kind = 'warning' THEN rule END) AS warnings,
  count(DISTINCT CASE WHEN kind IN ('optimisation', 'suggestion') THEN rule END) AS optimisations
  FROM (SELECT doc_id, rule, kind FROM found UNION ALL SELECT doc_id, NULL, NULL FROM documents) GROUP BY doc_id),
s AS (SELECT *, greatest(0, 100 - warnings * 10 - optimisations * 5) AS score FROM n)
SELECT *, CASE WHEN score >= 80 THEN 'excellent' WHEN score >= 60 THEN 'good' WHEN score >= 40 THEN 'needs improvement'
          ELSE 'poor' END AS band FROM s
""")
def rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    return textrules.rule_scores(code_texts(spark, sf), "doc_id", "code")


def _count_sql(*patterns: str) -> str:
    return " + ".join(_times(p) for p in patterns)


@query(f"""
WITH {CELLS_SQL}, n AS (SELECT doc_id, CAST(cell AS BIGINT) AS cell,
  {_count_sql('spark.read', 'spark.table')} AS reads, {_count_sql('.write.')} AS writes,
  {_count_sql('.withColumn', '.select', '.filter')} AS transformations,
  {_count_sql('.show()', '.count()', '.collect()')} AS actions FROM cells)
SELECT *, reads + writes + transformations + actions AS total_operations FROM n
""")
def op_counts(spark: SparkSession, sf: str) -> DataFrame:
    cells = code_texts(spark, sf).withColumn("cell", F.col("cell").cast("bigint"))
    return textrules.operation_counts(cells, ["doc_id", "cell"], "code")


PRIORITY = "CASE kind WHEN 'issue' THEN 4 WHEN 'warning' THEN 3 WHEN 'optimisation' THEN 2 ELSE 1 END"


@query(f"""
WITH {CELLS_SQL}, found AS ({_findings_sql(SCAN_SQL)})
SELECT rule, kind, count(*) AS places, CAST({PRIORITY} AS BIGINT) AS priority FROM found GROUP BY rule, kind
ORDER BY priority DESC, rule LIMIT 5
""")
def top5_findings(spark: SparkSession, sf: str) -> DataFrame:
    found = textrules.distinct_findings(rule_findings(spark, sf))
    return top_by_priority(found.withColumn("priority", F.expr(f"CAST({PRIORITY} AS BIGINT)")), "priority", "rule")


WORD_RULES = (
    Rule("mentions_rights", OPTIMISATION, ("copyright", "license"), any_case=True),
    Rule("mail_without_link", OPTIMISATION, ("@",), ("http",)),
    Rule("many_the", OPTIMISATION, (" the ",), over=20),
)


@query("""
SELECT doc_id, 'mentions_rights' AS rule, 'optimisation' AS kind FROM documents
WHERE contains(lower(text), 'copyright') OR contains(lower(text), 'license')
UNION ALL SELECT doc_id, 'mail_without_link', 'optimisation' FROM documents
WHERE contains(text, '@') AND NOT contains(text, 'http')
UNION ALL SELECT doc_id, 'many_the', 'optimisation' FROM documents
WHERE (length(text) - length(replace(text, ' the ', ''))) // 5 > 20
""")
def document_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The same scan with the user's own rules, on the documents as they are."""
    return textrules.rule_findings(table(spark, sf, "documents"), ["doc_id"], "text", WORD_RULES)


@query("""
SELECT source, lang, doc_id FROM documents
WHERE contains(lower(text), 'license') OR contains(lower(source), 'c19') OR contains(lower(lang), 'fr')
ORDER BY source, lang, doc_id
""")
def contains_search(spark: SparkSession, sf: str) -> DataFrame:
    """Rows where the term's any-case form occurs in one of three columns, in a fixed order."""
    documents = table(spark, sf, "documents")
    hit = (contains_any_case("LICENSE", F.col("text")) | contains_any_case("C19", F.col("source"))
           | contains_any_case("FR", F.col("lang")))
    return documents.filter(hit).select("source", "lang", "doc_id").orderBy("source", "lang", "doc_id")


@query("""
SELECT page_id, url FROM pages WHERE contains(lower(url), 'de') OR contains(lower(html), 'de') ORDER BY url, page_id
""")
def page_search(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.filter(contains_any_case("De", F.col("url"), F.col("html"))).select("page_id", "url") \
        .orderBy("url", "page_id")


REQUEST = """text || CASE role WHEN 'user' THEN ' Create notebook called "' || role || ' x" to validate the schema'
  WHEN 'assistant' THEN ' Explore lakehouse tables' ELSE ' "Night Run" notebook' END"""


def _hits_sql(words) -> str:
    return " + ".join(f"CAST(contains(lower(request), '{w}') AS INTEGER)" for w in words)


def _any_sql(words) -> str:
    return "(" + " OR ".join(f"contains(lower(request), '{w}')" for w in words) + ")"


@query(f"""
WITH r AS (SELECT conv_id, turn, {REQUEST} AS request FROM conversations),
h AS (SELECT *, {_hits_sql(['notebook', 'code', 'validate', 'pyspark', 'spark', 'script', 'ml', 'machine learning',
                            'analytics', 'etl pipeline'])} AS n,
  {_hits_sql(['lakehouse', 'table', 'data', 'schema', 'database', 'query', 'explore data', 'discover', 'storage'])} AS l
  FROM r)
SELECT conv_id, turn, CASE WHEN n > l THEN 'notebook' WHEN l > n THEN 'lakehouse' ELSE 'unknown' END AS domain,
  CASE WHEN {_any_sql(['etl', 'pipeline', 'extract', 'transform', 'load'])} THEN 'etl'
    WHEN {_any_sql(['analytics', 'analysis', 'aggregate', 'report'])} THEN 'analytics'
    WHEN {_any_sql(['ml', 'machine learning', 'model', 'train', 'predict'])} THEN 'ml'
    WHEN {_any_sql(['streaming', 'real-time', 'stream', 'event'])} THEN 'streaming'
    WHEN {_any_sql(['lakehouse integration', 'integrate'])} THEN 'integration' ELSE 'basic' END AS template,
  coalesce(nullif(regexp_extract(request, 'called [''"]([^''"]+)[''"]', 1), ''),
           nullif(regexp_extract(request, 'named [''"]([^''"]+)[''"]', 1), ''),
           nullif(regexp_extract(request, '[''"]([^''"]+)[''"] notebook', 1), '')) AS name
FROM h
""")
def keyword_routing(spark: SparkSession, sf: str) -> DataFrame:
    request = F.expr(REQUEST)
    return spread_if_small(table(spark, sf, "conversations")).select(
        "conv_id", "turn",
        textrules.route(request).alias("domain"),
        textrules.first_class(request).alias("template"),
        textrules.quoted_name(request).alias("name"))


@query("""
SELECT doc_id, CASE WHEN length(text) > 500 THEN left(text, 500) || chr(10) || '... [truncated, ' || (length(text) - 500)
         || ' chars omitted]' ELSE text END AS shown,
       CASE WHEN length(source) > 4 THEN left(source, 4) || '...' ELSE source END AS short_source
FROM documents
""")
def truncated_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", truncate_counted(F.col("text"), 500).alias("shown"),
        truncate_marked(F.col("source"), 4).alias("short_source"))


@query("""
SELECT doc_id, CAST(1 AS BIGINT) AS position, text AS source FROM documents WHERE text <> ''
UNION ALL SELECT doc_id, 2, lang || ' = ' || source FROM documents
""")
def notebook_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Notebook JSON made of each document: a heading, its lines as a list, one text cell, an empty cell."""
    def cell(kind: str, source):
        return F.concat(F.lit(f'{{"cell_type":"{kind}","metadata":{{}},"source":'), source, F.lit("}"))

    lines = F.split("text", "\n")
    ended = F.transform(lines, lambda line, i: F.when(i < F.size(lines) - 1, F.concat(line, F.lit("\n"))).otherwise(line))
    quoted = F.to_json(F.array(F.concat_ws(" = ", "lang", "source")))
    as_text = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    notebook = F.concat(
        F.lit('{"nbformat":4,"cells":['),
        F.concat_ws(",", cell("markdown", F.to_json(F.array(F.concat(F.lit("# "), "lang")))),
                    cell("code", F.to_json(ended)), cell("code", as_text), cell("code", F.lit('""'))),
        F.lit("]}"))
    books = spread_if_small(table(spark, sf, "documents")).select("doc_id", notebook.alias("notebook"))
    return textrules.code_cells(books, "doc_id", "notebook")
