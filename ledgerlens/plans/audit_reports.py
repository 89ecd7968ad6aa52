"""The two user-action reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.times import day_text, second_text
from ..operators import audit as A
from ..operators.snapshots import dedupe_ranked, latest_per_key
from ..sources.session import staged

REPORT_ORDER = ("start_time", "is_cumulative", "dt")


@dataclass(frozen=True)
class AuditSources:
    cases: DataFrame  # selected: case_id, model_id, start_time, end_time, is_cumulative
    log: DataFrame
    users: DataFrame  # id, name
    objects: DataFrame  # id, object_type_id
    object_types: DataFrame  # id, name
    names: DataFrame  # case_id, object_id, name
    products: DataFrame  # case_id, id, name
    excluded_type: int


def _described(log: DataFrame, src: AuditSources, labels: A.Labels) -> DataFrame:
    """User, object type and resolved texts. Object and type must exist and not be the excluded type;
    an unknown user stays with an empty name."""
    users = src.users.select(F.col("id").alias("user_id"), F.col("name").alias("_user"))
    types = src.object_types.filter(F.col("id") != src.excluded_type).select(
        F.col("id").alias("object_type_id"), F.col("name").alias("_type")
    )
    objects = src.objects.select(F.col("id").alias("object_id"), "object_type_id").join(types, "object_type_id")
    known = log.join(objects.select("object_id", "_type"), "object_id").join(users, "user_id", "left")
    named = known.withColumns(
        {
            "user_name": rules.labels(F.col("_user"), labels.masked_users),
            "object_type": rules.labels(F.col("_type"), labels.type_aliases),
        }
    ).drop("_user", "_type")
    return A.resolve_references(
        named, src.names, src.products, labels.object_attributes, labels.product_attributes
    )


def _newest_first(df: DataFrame) -> DataFrame:
    start, cumulative, at = REPORT_ORDER
    return df.orderBy(F.desc(start), F.asc(cumulative), F.desc(at))


def audit_report(src: AuditSources, labels: A.Labels) -> DataFrame:
    """One line per log row of the selected cases, newest period first."""
    log = _described(A.case_log(src.cases, src.log), src, labels)
    words = A.change_labels(labels)
    return _newest_first(log).select(
        "log_id",
        day_text(F.col("start_time")).alias("period_start"),
        day_text(F.col("end_time")).alias("period_end"),
        A.period_word(F.col("is_cumulative"), labels).alias("period_kind"),
        second_text(F.col("dt")).alias("action_time"),
        "user_name",
        "object_type",
        "object_name",
        rules.labels(F.col("history_type"), words).alias("change"),
        "attribute",
        F.col("prev_text").alias("prev"),
        F.col("new_text").alias("new"),
        A.yes_no(F.col("is_cancel"), labels).alias("cancelled"),
    )


def best_copies(src: AuditSources) -> DataFrame:
    """The log of the selected cases with one row per log id: excluded type last, unknown type last,
    highest case first."""
    types = src.objects.select(F.col("id").alias("object_id"), F.col("object_type_id").alias("_type_id"))
    log = A.case_log(src.cases, src.log, distinct=False).join(types, "object_id", "left")
    order = [
        F.when(F.col("_type_id") == src.excluded_type, 1).otherwise(0),
        F.when(F.col("_type_id").isNull(), 1).otherwise(0),
        -F.col("case_id"),
    ]
    return dedupe_ranked(log, "log_id", order).drop("_type_id")


def formatted_log(src: AuditSources, labels: A.Labels) -> DataFrame:
    return _described(best_copies(src), src, labels)


def audit_report_folded(
    src: AuditSources,
    labels: A.Labels,
    comments: DataFrame,
    signs: DataFrame,
    unit: str = "SECOND",
    per_part: int = 10_000,
) -> DataFrame:
    """De-duplicated log with creations and dependency changes folded, objects classified by name and the
    newest comment and sign attached. The formatted log feeds all branches, so it is stored once, split
    by branch. ``comments``/``signs``: id, log_id, text."""
    kind = F.when(F.col("history_type") == A.CREATED, F.lit("created")).when(
        A.is_dependency(labels), F.lit("dependency")
    ).otherwise(F.lit("plain"))
    log = staged(formatted_log(src, labels).withColumn("branch", kind), "audit", by=("branch",))
    rows = (
        A.fold_creations(log.filter(F.col("branch") == "created"), labels, unit, per_part)
        .unionByName(A.fold_dependencies(log.filter(F.col("branch") == "dependency"), labels, unit, per_part))
        .unionByName(A.plain_changes(log.filter(F.col("branch") == "plain"), labels))
    )
    rows = A.classify_by_name(
        rows, "object_name", labels.arrow, labels.name_rules, F.col("object_type"), "object_type"
    )
    comment = latest_per_key(comments, "log_id", "id").select("log_id", F.col("text").alias("comment"))
    sign = latest_per_key(signs, "log_id", "id").select("log_id", F.col("text").alias("sign"))
    joined = rows.join(comment, "log_id", "left").join(sign, "log_id", "left")
    return _newest_first(joined).select(
        "log_id",
        "part",
        day_text(F.col("start_time")).alias("period_start"),
        day_text(F.col("end_time")).alias("period_end"),
        A.period_word(F.col("is_cumulative"), labels).alias("period_kind"),
        second_text(F.col("dt")).alias("action_time"),
        "user_name",
        "object_type",
        "object_name",
        "change",
        "attribute",
        "prev",
        "new",
        A.yes_no(F.col("is_cancel"), labels).alias("cancelled"),
        F.coalesce("comment", F.lit("")).alias("comment"),
        F.coalesce("sign", F.lit("")).alias("sign"),
    )
