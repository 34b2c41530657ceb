"""Rule scans over texts, operation counts, scores, notebook cells and keyword routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.predicates import all_of, any_of
from tarnlake.functions.scalars import first_match, literal_count


@dataclass(frozen=True)
class Rule:
    """Fires when the text holds any of ``has``, more than ``over`` times, and none of ``lacks``.

    Without ``has`` only the absence counts. Matching is literal and, unless ``any_case``, case-sensitive.
    """

    name: str
    kind: str
    has: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    over: int = 0
    any_case: bool = False

    def fires(self, text: Column) -> Column:
        searched = F.lower(text) if self.any_case else text
        if self.over:
            present = any_of([literal_count(searched, p) > self.over for p in self.has])
        else:
            present = any_of([searched.contains(p) for p in self.has]) if self.has else F.lit(True)
        absent = all_of([~searched.contains(p) for p in self.lacks])
        return F.coalesce(present & absent, F.lit(False))


ISSUE, WARNING, SUGGESTION, OPTIMISATION = "issue", "warning", "suggestion", "optimisation"

# Fixed patterns of the three rule sets.
def platform_rules(helpers: str) -> tuple[Rule, ...]:
    """Rules for a platform whose own helper package has the given name."""
    return (
        Rule("own_session", ISSUE, ("SparkSession.builder",)),
        Rule("platform_utilities", SUGGESTION, ("lakehouse", "workspace"), (helpers,)),
        Rule("table_format", SUGGESTION, (".saveAsTable(",), ('format("delta")',)),
        Rule("jdbc_connector", SUGGESTION, ("jdbc",), any_case=True),
    )


HELPERS = "platform_helpers"
PLATFORM_RULES = platform_rules(HELPERS)
PERFORMANCE_RULES = (
    Rule("collect", WARNING, (".collect()",)),
    Rule("rdd_use", WARNING, ("rdd.",), ("parallelize",)),
    Rule("reads_without_cache", OPTIMISATION, ("spark.read",), (".cache()",), over=3),
    Rule("join_without_broadcast", OPTIMISATION, (".join(",), ("broadcast",)),
    Rule("write_without_partitions", OPTIMISATION, (".write.",), ("partitionBy",)),
)
STYLE_RULES = (
    Rule("no_imports", WARNING, (), ("from pyspark", "import pyspark")),
    Rule("collect_call", WARNING, (".collect()",)),
    Rule("to_pandas", WARNING, (".toPandas()",)),
    Rule("loop_over_collect", WARNING, ("for row in df.collect()",)),
    Rule("reuse_without_cache", SUGGESTION, ("df.",), (".cache()", ".persist()"), over=3),
    Rule("frame_without_schema", SUGGESTION, ("createDataFrame",), ("StructType",)),
    Rule("filter_without_nulls", SUGGESTION, (".filter(",), ("isNull", "isNotNull")),
    Rule("write_without_partition_by", SUGGESTION, (".write.",), ("partitionBy",)),
    Rule("write_without_format", SUGGESTION, (".write.",), ('format("delta")',)),
)
USAGE_RULES = (
    Rule("explicit_use", WARNING, ('spark.sql("USE',)),
    Rule("direct_paths", WARNING, ("hdfs://", "s3://")),
)
# Fixed patterns counted per kind of operation.
OPERATIONS = {
    "reads": ("spark.read", "spark.table"),
    "writes": (".write.",),
    "transformations": (".withColumn", ".select", ".filter"),
    "actions": (".show()", ".count()", ".collect()"),
}
# Fixed score: start, points off per distinct finding, and the lower bounds of the bands.
FULL_SCORE, WARNING_POINTS, OPTIMISATION_POINTS = 100, 10, 5
BANDS = ((80, "excellent"), (60, "good"), (40, "needs improvement"))
LOWEST_BAND = "poor"


def rule_findings(df: DataFrame, ids: Sequence[str], text: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per finding: (ids, rule, kind). All rules are tested in one pass; there is no join."""
    hits = F.array_compact(F.array(*[
        F.when(r.fires(F.col(text)), F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind")))
        for r in rules
    ]))
    return df.select(*ids, F.inline(hits))


def distinct_findings(findings: DataFrame) -> DataFrame:
    """Findings counted once per rule, with the number of places."""
    return findings.groupBy("rule", "kind").agg(F.count(F.lit(1)).alias("places"))


def operation_counts(df: DataFrame, ids: Sequence[str], text: str) -> DataFrame:
    """Reads, writes, transformations and actions per cell, and their total."""
    counts = {n: sum((literal_count(F.col(text), p) for p in ps), F.lit(0).cast("bigint"))
              for n, ps in OPERATIONS.items()}
    return df.select(*ids, *[c.alias(n) for n, c in counts.items()]).withColumn(
        "total_operations", sum((F.col(n) for n in OPERATIONS), F.lit(0).cast("bigint")))


def band(score: Column) -> Column:
    out = F.when(score >= BANDS[0][0], BANDS[0][1])
    for low, name in BANDS[1:]:
        out = out.when(score >= low, name)
    return out.otherwise(LOWEST_BAND)


def rule_scores(
    df: DataFrame,
    document: str,
    text: str,
    rules: Sequence[Rule] = (*PERFORMANCE_RULES, *PLATFORM_RULES),
) -> DataFrame:
    """Score per document over its cells: 10 points off per distinct warning, 5 per distinct
    optimisation or suggestion; issues do not count.

    Only one flag per rule is shuffled, never the text, and the flags combine before the shuffle.
    """
    counted = [r for r in rules if r.kind != ISSUE]
    flags = [F.max(r.fires(F.col(text)).cast("int")).alias(f"__f{i}") for i, r in enumerate(counted)]

    def found(*kinds: str) -> Column:
        return sum((F.col(f"__f{i}") for i, r in enumerate(counted) if r.kind in kinds), F.lit(0)).cast("bigint")

    warnings, optimisations = found(WARNING), found(OPTIMISATION, SUGGESTION)
    per_document = df.groupBy(document).agg(*flags).select(
        document, warnings.alias("warnings"), optimisations.alias("optimisations"))
    lost = F.col("warnings") * WARNING_POINTS + F.col("optimisations") * OPTIMISATION_POINTS
    score = F.greatest(F.lit(0).cast("bigint"), F.lit(FULL_SCORE) - lost)
    return per_document.withColumn("score", score).withColumn("band", band(F.col("score")))


def code_cells(df: DataFrame, document: str, notebook: str) -> DataFrame:
    """Code cells of notebook JSON: (document, position among all cells, source).

    The source may be a text or a list of lines; lines are joined with nothing between them. Empty
    cells are left out. The notebook is parsed once, and cells and their fields are read off the parsed value; a
    notebook that is itself a text under ``content`` is parsed where the outer one has no cells.
    """
    outer, cell = F.col("__outer"), F.col("__cell")
    held = F.col("__held")

    def read(field: str) -> Column:
        lines = F.try_variant_get(cell, f"$.{field}", "array<string>")
        return F.coalesce(F.array_join(lines, ""), F.try_variant_get(cell, f"$.{field}", "string"))

    def is_code(field: str) -> Column:
        return F.coalesce(F.try_variant_get(cell, f"$.{field}", "string") == "code", F.lit(False))

    inner = F.try_parse_json(F.try_variant_get(outer, "$.content", "string"))
    return (
        df.select(document, F.try_parse_json(notebook).alias("__outer"))
        .withColumn("__held", F.coalesce(F.try_variant_get(outer, "$.cells", "array<variant>"),
                                         F.try_variant_get(outer, "$.content.cells", "array<variant>")))
        .withColumn("__held", F.when(held.isNotNull(), held).otherwise(F.try_variant_get(inner, "$.cells", "array<variant>")))
        .select(document, F.posexplode("__held").alias("position", "__cell"))
        .filter(is_code("type") | is_code("cell_type"))
        .select(document, F.col("position").cast("bigint").alias("position"),
                F.coalesce(read("source"), read("content")).alias("source"))
        .filter(F.col("source") != "")
    )


# Fixed word lists of the two-class router.
DOMAIN_WORDS = {
    "notebook": ("notebook", "code", "validate", "pyspark", "spark", "script",
                 "ml", "machine learning", "analytics", "etl pipeline"),
    "lakehouse": ("lakehouse", "table", "data", "schema", "database", "query",
                  "explore data", "discover", "storage"),
}
NO_DOMAIN = "unknown"
# Fixed word lists of the ordered template choice; the first list with a hit wins. A user of a named
# platform passes its name as one more word of the integration class.
TEMPLATE_WORDS = {
    "etl": ("etl", "pipeline", "extract", "transform", "load"),
    "analytics": ("analytics", "analysis", "aggregate", "report"),
    "ml": ("ml", "machine learning", "model", "train", "predict"),
    "streaming": ("streaming", "real-time", "stream", "event"),
    "integration": ("lakehouse integration", "integrate"),
}
DEFAULT_TEMPLATE = "basic"
# Fixed patterns of a quoted name.
NAME_PATTERNS = (
    r"called ['\"]([^'\"]+)['\"]",
    r"named ['\"]([^'\"]+)['\"]",
    r"['\"]([^'\"]+)['\"] notebook",
)


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """Number of words that occur in the lower-cased text, by substring."""
    return sum((F.lower(text).contains(w).cast("bigint") for w in words), F.lit(0).cast("bigint"))


def route(text: Column, classes: Mapping[str, Sequence[str]] = DOMAIN_WORDS, tie: str = NO_DOMAIN) -> Column:
    """Class with the most keyword hits; a tie for the lead gives ``tie``."""
    hits = {name: keyword_hits(text, words) for name, words in classes.items()}
    out = None
    for name, own in hits.items():
        leads = all_of([own > other for n, other in hits.items() if n != name])
        out = F.when(leads, name) if out is None else out.when(leads, name)
    return out.otherwise(tie)


def first_class(
    text: Column, classes: Mapping[str, Sequence[str]] = TEMPLATE_WORDS, default: str = DEFAULT_TEMPLATE
) -> Column:
    """First class, in order, any of whose words occurs in the lower-cased text."""
    return F.coalesce(
        *[F.when(any_of([F.lower(text).contains(w) for w in words]), name) for name, words in classes.items()],
        F.lit(default),
    )


def quoted_name(text: Column) -> Column:
    return first_match(text, NAME_PATTERNS)
