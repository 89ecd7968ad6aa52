"""User-action log: decoding, reference lookup, folding, classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.grouping import listed_text
from ..functions.text import text_before
from ..functions.times import truncate
from ..sources.session import staged

CREATED, DELETED, EDITED, SYSTEM = 0, 1, 2, 4

LOG_COLUMNS = (
    "log_id dt object_id user_id history_type attribute attribute_sf prev new is_cancel".split()
)
FOLDED_COLUMNS = (
    "log_id part start_time end_time is_cumulative dt user_name object_type object_name change attribute prev new is_cancel"
).split()


@dataclass(frozen=True)
class Labels:
    """Words and names of a report. All of it is configuration."""

    cumulative: str = "cumulative"
    daily: str = "daily"
    yes: str = "yes"
    no: str = "no"
    created: str = "created"
    deleted: str = "deleted"
    edited: str = "edited"
    system: str = "system"
    info: str = "info"
    masked_users: Mapping[str, str] = field(default_factory=dict)
    type_aliases: Mapping[str, str] = field(default_factory=dict)
    object_attributes: Sequence[str] = ("PrototypeId", "SourceId", "DestId")
    product_attributes: Sequence[str] = ("ProductId", "SecondProductId")
    dependency_attribute: str = "Dependency state"
    dependency_prefix: str = "Dependency "
    dependency_title: str = "Dependencies: "
    arrow: str = " -> "
    name_rules: Sequence[Mapping] = ()


def case_log(cases: DataFrame, log: DataFrame, distinct: bool = True) -> DataFrame:
    """Log rows of the selected cases; ``distinct`` drops exact duplicates.

    The cases are a calendar selection, so AQE can broadcast them and filter the log where it is read.
    """
    on = ["case_id", "model_id"] if "model_id" in log.columns else ["case_id"]
    chosen = cases.select(*on, "start_time", "end_time", "is_cumulative")
    out = log.join(chosen, on).select("case_id", "is_cumulative", "start_time", "end_time", *LOG_COLUMNS)
    return out.distinct() if distinct else out


def decode_labels(df: DataFrame, maps: Mapping[str, tuple[str, Mapping, Column | None]]) -> DataFrame:
    """Adds label columns: name -> (code column, {code: label}, default or None for the code's own text)."""
    return df.withColumns({name: rules.labels(F.col(c), mapping, default) for name, (c, mapping, default) in maps.items()})


def change_labels(labels: Labels) -> dict:
    return {CREATED: labels.created, DELETED: labels.deleted, EDITED: labels.edited, SYSTEM: labels.system}


def yes_no(col: Column, labels: Labels) -> Column:
    return F.when(col == 1, F.lit(labels.yes)).otherwise(F.lit(labels.no))


def period_word(col: Column, labels: Labels) -> Column:
    return F.when(col == 1, F.lit(labels.cumulative)).otherwise(F.lit(labels.daily))


def resolve_references(
    log: DataFrame,
    names: DataFrame,
    products: DataFrame,
    object_attrs: Sequence[str],
    product_attrs: Sequence[str],
) -> DataFrame:
    """Adds object_name, prev_text, new_text: an id under an object or product attribute becomes the name
    it has in the case (null when the case does not know it), any other text stays.

    ``names``: case_id, object_id, name; ``products``: case_id, id, name. Both kinds form one lookup relation. The log is stored
    once with a number for each row; what its rows refer to, up to three references each as (row, role) pairs of a few bytes,
    meets the relation in one join. The names found come back as one row per log row, and only then does the log itself move, once,
    by its row numbers, so no object or case that many rows refer to gathers them.
    """
    known = names.select(
        "case_id", F.lit("object").alias("kind"), F.col("object_id").cast("bigint").alias("ref"), "name"
    ).unionByName(products.select("case_id", F.lit("product").alias("kind"), F.col("id").cast("bigint").alias("ref"), "name"))
    known = staged(known.groupBy("case_id", "kind", "ref").agg(F.min("name").alias("name")), "known_names")
    rows = staged(log.withColumn("_row", F.monotonically_increasing_id()), "audit_rows")  # stored numbers stay as they are

    kind = F.when(F.col("attribute_sf").isin(list(object_attrs)), F.lit("object")).when(
        F.col("attribute_sf").isin(list(product_attrs)), F.lit("product")
    )

    def reference(role: str, of: Column, ref: Column) -> Column:
        whole = F.struct(F.lit(role).alias("role"), of.alias("kind"), ref.alias("ref"))
        return F.when(of.isNotNull() & ref.isNotNull(), whole)

    ids = {text: F.col(text).try_cast("bigint") for text in ("prev", "new")}
    wanted = [reference("object", F.lit("object"), F.col("object_id").cast("bigint")), *[reference(t, kind, i) for t, i in ids.items()]]
    pairs = rows.select("_row", "case_id", F.explode(F.array_compact(F.array(*wanted))).alias("_r")).select("_row", "case_id", "_r.*")
    found = pairs.join(known, ["case_id", "kind", "ref"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("role") == role, F.col("name"))).alias(f"_{role}") for role in ("object", "prev", "new")]
    )
    texts = {f"{t}_text": F.when(kind.isNotNull() & i.isNotNull(), F.col(f"_{t}")).otherwise(F.col(t)) for t, i in ids.items()}
    named = rows.join(found, "_row", "left").withColumns({"object_name": F.col("_object"), **texts})
    return named.drop("_row", "_object", "_prev", "_new")


def fold_creations(log: DataFrame, labels: Labels, unit: str = "SECOND", per_part: int = 10_000) -> DataFrame:
    """Creation rows of one time unit, object and user become one row listing "attribute=value, ...".

    The list is keyed (unit, object, user), coarser than the row's own group, and sorted by attribute and
    log id. Each stretch of ``per_part`` entries is a row, numbered by ``part``: the parts in order are the list.
    """
    made = log.filter(F.col("history_type") == CREATED).withColumn("dt", truncate(F.col("dt"), unit))
    group = [
        "start_time", "end_time", "is_cumulative", "dt", "user_name", "object_type", "object_name", "is_cancel",
        "object_id", "user_id",
    ]
    groups = made.groupBy(*group).agg(F.min("log_id").alias("log_id"))
    entry = F.concat(F.col("attribute"), F.lit("="), F.coalesce("new_text", F.lit("NULL")))
    lists = listed_text(
        made,
        ["dt", "object_id", "user_id"],
        entry,
        [F.col("attribute")],
        F.col("log_id"),
        per_part=per_part,
    )
    return (
        groups.join(lists, ["dt", "object_id", "user_id"], "left")
        .withColumns(
            {
                "part": F.coalesce("part", F.lit(0)),
                "change": F.lit(labels.created),
                "attribute": F.nullif(F.col("items"), F.lit("")),
                "prev": F.lit(None).cast("string"),
                "new": F.lit(None).cast("string"),
            }
        )
        .select(*FOLDED_COLUMNS)
    )


def is_dependency(labels: Labels) -> Column:
    return (F.col("attribute") == labels.dependency_attribute) & (F.col("history_type") == SYSTEM)


def fold_dependencies(log: DataFrame, labels: Labels, unit: str = "SECOND", per_part: int = 10_000) -> DataFrame:
    """Dependency-state rows of one time unit and user become one row naming all objects by log id, prefix
    stripped, in parts as above; old and new are the largest raw texts."""
    states = log.filter(is_dependency(labels)).withColumn("dt", truncate(F.col("dt"), unit))
    group = ["start_time", "end_time", "is_cumulative", "dt", "user_name", "object_type", "is_cancel", "user_id"]
    groups = states.groupBy(*group).agg(
        F.min("log_id").alias("log_id"), F.max("prev").alias("prev"), F.max("new").alias("new")
    )
    short = F.replace(F.col("object_name"), F.lit(labels.dependency_prefix), F.lit(""))
    lists = listed_text(states, ["dt", "user_id"], short, [], F.col("log_id"), per_part=per_part)
    return (
        groups.join(lists, ["dt", "user_id"], "left")
        .withColumns(
            {
                "part": F.coalesce("part", F.lit(0)),
                "object_name": F.concat(F.lit(labels.dependency_title), F.nullif(F.col("items"), F.lit(""))),
                "change": F.lit(labels.system),
                "attribute": F.lit(labels.dependency_attribute),
            }
        )
        .select(*FOLDED_COLUMNS)
    )


def plain_changes(log: DataFrame, labels: Labels) -> DataFrame:
    """All other rows, full-precision time. A null attribute of type 4 is unknown and drops out."""
    words = {DELETED: labels.deleted, EDITED: labels.edited}
    rest = log.filter((F.col("history_type") != CREATED) & ~is_dependency(labels))
    return rest.withColumns(
        {
            "part": F.lit(0),
            "change": rules.labels(F.col("history_type"), words, F.lit(labels.info)),
            "prev": F.col("prev_text"),
            "new": F.col("new_text"),
        }
    ).select(*FOLDED_COLUMNS)


def classify_by_name(
    df: DataFrame, col: str, delimiter: str, ladder: Sequence[Mapping], default: Column, out: str
) -> DataFrame:
    """Label by the name left of the delimiter, through an ordered LIKE ladder; ``default`` otherwise."""
    return df.withColumn(out, rules.ladder(text_before(F.col(col), delimiter), ladder, default))
