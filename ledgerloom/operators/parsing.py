"""JSON transactions: validation, dead-letter branch, event time."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.times import iso_instant
from ledgerloom.schemas import TRANSACTION

# Keys a transaction must carry, and keys the session features read.
REQUIRED_KEYS = ("transaction_id", "user_id", "amount", "timestamp")
FEATURE_KEYS = ("merchant_category", "location")

#: A valid transaction as it is parsed.
PARSED_ROW = T.StructType(
    [
        *TRANSACTION.fields,
        T.StructField("event_time", T.TimestampType()),
        T.StructField("members", T.MapType(T.StringType(), T.VariantType())),
    ]
)

VALID = "valid"
DEAD_LETTER = "dead_letter"
DROPPED = "dropped"


def _lacks(members: Column, names: tuple[str, ...]) -> Column:
    present = [F.map_contains_key(members, name) for name in names]
    return ~functools.reduce(operator.and_, present)


def _text(value: Column) -> Column:
    """A member as text: strings as they are, anything else as its JSON."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).when(
        F.schema_of_variant(value) != "VOID", F.to_json(value)
    )


def _typed(value: Column, kind: T.DataType) -> Column:
    """A member as a declared type, NULL if it has another."""
    if isinstance(kind, T.StringType):
        return _text(value)
    shown = {"double": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": r"^BOOLEAN$"}[kind.simpleString()]
    return F.when(F.schema_of_variant(value).rlike(shown), F.try_variant_get(value, "$", kind.simpleString()))


def _last_of_each(members: Column) -> Column:
    """Of keys that are repeated, the last value, at the place of the last."""
    names = F.map_keys(members)
    last = F.filter(
        F.map_entries(members), lambda e, i: i == F.size(names) - F.array_position(F.reverse(names), e["key"]).cast("int")
    )
    return F.when(F.size(F.array_distinct(names)) == F.size(names), members).otherwise(F.map_from_entries(last))


def parse_transactions(lines: DataFrame, on_missing: str = "dead_letter") -> DataFrame:
    """Parse the ``value`` column of ``lines``.

    Every input line gives one output row with the raw ``value``, a ``parse_status``
    (``valid``, ``dead_letter`` or ``dropped``), a ``reason``, the declared transaction
    columns, ``event_time``, and ``members``, a map of all keys of the object with their JSON values.
    A declared field of another type is NULL in its column and itself in ``members``; an absent one is
    NULL and absent. ``on_missing`` says what happens to objects without a required key: ``dead_letter``
    keeps them in the dead-letter branch, ``drop`` marks them as dropped.

    Of a key that is repeated the last value counts; inside a nested object a repeated key makes the line a
    dead letter. NaN and infinities, which JSON does not have, are kept as text.
    """
    if on_missing not in ("dead_letter", "drop"):
        raise ValueError("on_missing must be 'dead_letter' or 'drop'")
    # Brackets around the line make the JSON reader consume all of it: text after the
    # object, or a second object, no longer passes as a single valid element.
    whole = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    objects = F.from_json(whole, "array<map<string,variant>>", {"allowSingleQuotes": "false"})
    looks_like_object = F.col("value").rlike(r"(?s)^\s*\{.*\}\s*$")

    known = [f.name for f in TRANSACTION.fields]
    parse = F.struct(looks_like_object.alias("object"), objects.alias("objects"))
    single = F.col("j.object") & (F.size("j.objects") == 1)
    member = F.col("members")
    staged = (
        lines.select("value", _once(parse).alias("j"))
        .select("value", F.when(single, F.get("j.objects", F.lit(0))).alias("members"))
        .withColumn("members", _last_of_each(member))
        .select("*", *[_typed(member[f.name], f.dataType).alias(f.name) for f in TRANSACTION.fields])
        .withColumn("event_time", iso_instant(F.col("timestamp")))
    )
    reason = (
        F.when(member.isNull(), F.lit("not a JSON object"))
        .when(_lacks(member, REQUIRED_KEYS), F.lit("missing required key"))
        .when(_lacks(member, FEATURE_KEYS), F.lit("missing feature key"))
        .when(F.col("amount").isNull() | F.isnan("amount"), F.lit("amount is not a number"))
        .when(F.col("event_time").isNull(), F.lit("timestamp is not ISO-8601"))
    )
    missing_status = DROPPED if on_missing == "drop" else DEAD_LETTER
    status = (
        F.when(F.col("reason").isNull(), F.lit(VALID))
        .when(F.col("reason") == "missing required key", F.lit(missing_status))
        .otherwise(F.lit(DEAD_LETTER))
    )
    return (
        staged.select("*", _once(F.struct(reason.alias("reason"))).alias("r"))
        .withColumn("reason", F.col("r.reason"))
        .withColumn("parse_status", status)
        .select("value", "parse_status", "reason", *known, "event_time", "members")
    )


def _once(value: Column) -> Column:
    """``value`` as a generated column.

    The optimizer leaves later filters and projections above a generator, so an expensive
    value is computed once per row and not again for every column and predicate that uses it.
    """
    return F.explode_outer(F.array(value))


def valid_rows(parsed: DataFrame) -> DataFrame:
    """The main branch: typed transactions."""
    return parsed.where(F.col("parse_status") == VALID).drop("value", "parse_status", "reason")


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The dead-letter branch: raw line as received, and why it was refused."""
    return parsed.where(F.col("parse_status") == DEAD_LETTER).select("value", "reason")


def copy_event_time(df: DataFrame, source: str = "timestamp", target: str = "event_time") -> DataFrame:
    """Copy the timestamp text unchanged into another field."""
    return df.withColumn(target, F.col(source))
