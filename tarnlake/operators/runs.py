"""Job-run analytics over tables of runs, refreshes and their details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.predicates import contains_any_word, optional_equals
from tarnlake.functions.scalars import (
    UNKNOWN,
    duration_label,
    error_field,
    error_items,
    error_struct,
    first_non_empty,
    iso_timestamp,
    json_errors,
    json_object,
    object_field,
    run_duration,
    seconds_between,
)
from tarnlake.operators.joins import with_names
from tarnlake.operators.topk import (
    NEWEST_PER_GROUP,
    PREVIEW_ROWS,
    RECORDS_KEPT,
    checked_cap,
    newest_first,
    newest_per_group,
)
from tarnlake.sizing import broadcast_if_small

# Fixed values of the run and refresh records.
FAILED = "Failed"
CANCELLED = "Cancelled"
USER = "User"
REASON_FIELDS = ("failureReason", "errorMessage", "error", "message")
SUBMITTER_FIELDS = ("displayName", "userPrincipalName", "mail", "name", "id")
REFRESH_TOP_MAX, REFRESH_TOP_DEFAULT = 100, 10
NO_DESCRIPTION = "No description"

# More run ids than this are joined without a broadcast.
BROADCAST_RUNS = 100_000


def list_runs(
    runs: DataFrame,
    workspace: str = "workspace_id",
    submitted: str = "submitted",
    run_id: str = "run_id",
    state: str | None = None,
    item_type: str | None = None,
    newest: int = NEWEST_PER_GROUP,
) -> DataFrame:
    """Runs of all workspaces, newest ``newest`` of each, newest first.

    The state filter comes before the per-workspace limit and the item
    type after it.
    """
    kept = newest_per_group(optional_equals(runs, state=state), workspace, submitted, run_id, newest)
    return newest_first(optional_equals(kept, item_type=item_type), submitted, run_id)


def failure_reason(parsed: Column) -> Column:
    """The first reason that a parsed detail record gives."""
    return first_non_empty(*[object_field(parsed, f) for f in REASON_FIELDS])


def list_failures(runs: DataFrame, details: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """Newest failed runs with the reason from their detail record.

    The cap comes before the join: ``rows`` runs meet the details, not all failures.
    """
    failed = newest_first(runs.filter(F.col("state") == FAILED), "submitted", "run_id").limit(rows)
    # A small cap bounds the id list: it is broadcast, and the details are not shuffled.
    ids = failed.select("run_id")
    wanted = details.join(F.broadcast(ids) if rows <= BROADCAST_RUNS else ids, "run_id", "left_semi")
    return (
        failed.join(wanted, "run_id", "left")
        .withColumn("__detail", json_object(F.col("detail")))
        .withColumn("reason", failure_reason(F.col("__detail")))
        .drop("__detail", *[c for c in details.columns if c != "run_id"])
    )


def find_failures(runs: DataFrame, words: Sequence[str], name: str = "item_name") -> DataFrame:
    """Failed runs whose name contains any of the words (exact case); all failures when none match.

    Whether one matches is a scalar subquery of the same plan.
    """
    failed = runs.filter(F.col("state") == FAILED).withColumn("__hit", contains_any_word(F.col(name), words))
    some = failed.agg(F.coalesce(F.bool_or("__hit"), F.lit(False)))
    return failed.filter(F.coalesce(F.col("__hit"), F.lit(False)) | ~some.scalar()).drop("__hit")


def run_statistics(runs: DataFrame, operation: str, time: str, tie: str, seconds: str, success: Column,
                   kept: int = RECORDS_KEPT) -> DataFrame:
    """Statistics of the last ``kept`` runs of each operation."""
    last = newest_per_group(runs.withColumn("__ok", success), operation, time, tie, kept)
    total, good = F.count(F.lit(1)), F.count_if(F.col("__ok"))
    return last.groupBy(operation).agg(
        total.alias("total_executions"),
        good.alias("successful_executions"),
        (good / total * 100).alias("success_rate"),
        F.avg(seconds).alias("average_execution_time"),
        F.min(seconds).alias("fastest_execution"),
        F.max(seconds).alias("slowest_execution"),
    )


def submitter_name(submitter: str = "submitter") -> Column:
    return first_non_empty(*[F.col(f"{submitter}.{f}") for f in SUBMITTER_FIELDS])


def with_user_names(runs: DataFrame, users: DataFrame, submitter: str = "submitter") -> DataFrame:
    """The submitter's names as the directory has them, where the submitter is a user that it knows.

    ``users`` holds one row per id: (id, displayName, userPrincipalName, mail); what it lacks becomes empty text.
    """
    known = users.select(F.col("id").alias("__id"), F.struct("displayName", "userPrincipalName", "mail").alias("__user"))
    is_user = (F.col(f"{submitter}.type") == USER) & (F.col(f"{submitter}.id") == F.col("__id"))
    names = {f: F.when(F.col("__user").isNotNull(), F.coalesce(F.col(f"__user.{f}"), F.lit(""))).otherwise(F.col(f"{submitter}.{f}"))
             for f in ("displayName", "userPrincipalName", "mail")}
    joined = runs.join(broadcast_if_small(known), is_user, "left")
    return joined.withColumn(submitter, F.col(submitter).withField("displayName", names["displayName"])
                             .withField("userPrincipalName", names["userPrincipalName"]).withField("mail", names["mail"])) \
        .drop("__id", "__user")


def run_details(runs: DataFrame, workspaces: DataFrame, capacities: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Runs with the names of workspace, capacity and submitter, duration text, and why they failed or were cancelled.

    Columns read: run_id, workspace_id, capacity_id, state, submitted and ended (ISO text), total_duration (text, which
    goes before the computed one), submitter (struct), cancellation_reason, detail (JSON text, parsed once).
    ``workspaces`` and ``capacities`` have (id, name), ``users`` as ``with_user_names`` reads them.
    """
    named = with_names(runs, {"workspace_id": "workspace_name"}, workspaces, "id", "name")
    named = with_names(named, {"capacity_id": "capacity_name"}, capacities, "id", "name")
    named = with_user_names(named, users)
    start, end = iso_timestamp(F.col("submitted")), iso_timestamp(F.col("ended"))
    failed = F.col("state") == FAILED
    detail = F.col("__detail")
    return named.withColumn("__detail", F.when(failed, json_object(F.col("detail")))).select(
        "run_id",
        "workspace_id",
        "workspace_name",
        "capacity_name",
        F.coalesce("state", F.lit(UNKNOWN)).alias("state"),
        F.coalesce(first_non_empty(F.col("total_duration")), run_duration(start, end, F.col("state"), as_of)).alias("duration"),
        submitter_name().alias("submitted_by"),
        F.when(F.col("state") == CANCELLED, first_non_empty(F.col("cancellation_reason"))).alias("cancellation_reason"),
        F.when(failed, failure_reason(detail)).alias("reason"),
        F.when(failed, first_non_empty(object_field(detail, "rootActivityId"))).alias("root_activity_id"),
    )


def run_errors(runs: DataFrame, errors: str = "errors", keep_empty: bool = False) -> DataFrame:
    """One row per error of a run: (code, message, source). Runs without errors drop out unless kept. The text of the
    errors is parsed once."""
    explode = F.explode_outer if keep_empty else F.explode
    items = runs.withColumn("__parsed", json_errors(F.col(errors))).select(
        *[c for c in runs.columns if c != errors], explode(error_items(F.col(errors), F.col("__parsed"))).alias("__item"))
    return items.withColumn("__e", error_struct(F.col("__item"))).select(
        *[c for c in runs.columns if c != errors], "__e.code", "__e.message", "__e.source")


def clean_time(text: Column) -> Column:
    """ISO text as shown in a listing."""
    return F.left(F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(" UTC")), F.lit(22))


def refresh_history(refreshes: DataFrame, top: int = REFRESH_TOP_DEFAULT) -> DataFrame:
    """Newest refreshes with a duration label; failed ones with error code and text.

    Columns read: id, status, refresh_type, start and end (ISO text), error (JSON text).
    """
    newest = refreshes.orderBy(F.desc_nulls_last("start"), "id").limit(checked_cap(top, 1, REFRESH_TOP_MAX))
    seconds = seconds_between(iso_timestamp(F.col("start")), iso_timestamp(F.col("end")))
    failed, error = F.col("status") == FAILED, F.col("__error")
    return newest.withColumn("__error", F.when(failed, json_object(F.col("error")))).select(
        "id",
        F.coalesce("status", F.lit(UNKNOWN)).alias("status"),
        F.coalesce("refresh_type", F.lit(UNKNOWN)).alias("refresh_type"),
        clean_time(F.col("start")).alias("start"),
        clean_time(F.col("end")).alias("end"),
        duration_label(seconds).alias("duration"),
        F.when(failed, error_field(error, "errorCode", UNKNOWN)).alias("error_code"),
        F.when(failed, F.coalesce(error_field(error, "errorDescription", NO_DESCRIPTION), F.col("error"))).alias("error_text"),
    )
