"""Which schema does a text table have, and does archived data still fit a new one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.operators.silver import NUMBER_TYPES

_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
_WHOLE = r"^\s*[+-]?\d{1,18}\s*$"
_TRUTH = r"^(?i:true|false)$"


def profile(
    text: DataFrame,
    required: list[str],
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """Position, type and nullability of each column of an all-text table.

    Numbers, columns without any value, and true/false columns without a null are
    ``double``; everything else is ``string``. ``overrides`` fixes the type of named
    columns.
    """
    facts: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(text.columns):
        value = F.col(f"`{name}`")
        facts += [
            F.count(value).alias(f"_known{i}"),
            F.count_if(value.rlike(_NUMBER)).alias(f"_number{i}"),
            F.count_if(value.rlike(_TRUTH)).alias(f"_truth{i}"),
        ]
    columns = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(name).alias("field"),
            F.lit((overrides or {}).get(name)).cast("string").alias("_fixed"),
            F.lit(name in required).alias("required"),
            F.col(f"_known{i}").alias("n_values"),
            F.col(f"_number{i}").alias("_number"),
            F.col(f"_truth{i}").alias("_truth"),
        )
        for i, name in enumerate(text.columns)
    ]
    numeric = (F.col("_number") == F.col("n_values")) | (
        (F.col("_truth") == F.col("n_values")) & (F.col("n_values") == F.col("_rows"))
    )
    kind = F.coalesce("_fixed", F.when(numeric, "double").otherwise("string"))
    return (
        text.agg(*facts)
        .select("_rows", F.explode(F.array(*columns)).alias("_c"))
        .select("_rows", "_c.*")
        .select(
            "position",
            "field",
            kind.alias("type"),
            (~F.col("required")).alias("nullable"),
            "n_values",
            (F.col("_rows") - F.col("n_values")).alias("n_nulls"),
        )
    )


def schema_from_profile(profiled: DataFrame) -> T.StructType:
    """The profiled schema; it has one row per column of the table."""
    kinds = {"double": T.DoubleType(), "long": T.LongType(), "string": T.StringType()}
    rows = profiled.orderBy("position").collect()
    return T.StructType([T.StructField(r.field, kinds[r.type], r.nullable) for r in rows])


@dataclass(frozen=True)
class ProposedField:
    """A field of a schema that is to read the archive. Without a default it must be present."""

    name: str
    type: str = "double"
    nullable: bool = True
    has_default: bool = True


def drift(
    bronze: DataFrame,
    proposed: list[ProposedField],
    value: str = "kafka_value",
    version: str = "schema_version",
) -> DataFrame:
    """Per archived schema version and proposed field: rows the new schema could not read.

    ``n_missing``: absent and no default. ``n_null``: null into a non-nullable field.
    ``n_mistyped``: a value that does not convert. Fields absent from the proposal are
    ignored, as removing a field is always allowed.
    """
    text = F.col(value)
    # Whether a field is there is only asked of those that must be there, or must not be null.
    strict = F.array(*[F.lit(f.name) for f in proposed if not (f.nullable and f.has_default)])
    strict = strict.cast("array<string>")
    there = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    read = bronze.where(text.isNotNull()).select(
        F.col(version).alias("_version"),
        F.from_json(text, T.StructType([T.StructField(f.name, T.StringType()) for f in proposed])).alias("_r"),
        F.when(F.size(strict) > 0, F.array_except(strict, there)).alias("_absent"),
    )
    # What is wrong with a record, by number of the field; nothing in most of them. One entry
    # without a field counts the record in the same pass.
    record = F.array(F.struct(F.lit(-1).alias("field"), F.lit(0).alias("fault")))
    faults = [record]
    for fault, found in _faults(proposed).items():
        if found:
            faults.append(_listed(list(found), F.array(*found.values()), fault))
    found = (
        read.select("_version", F.concat(*faults).alias("_faults"))
        # Never empty; the outer form keeps Spark from testing that before the record is parsed,
        # which would parse each field on its own.
        .select("_version", F.inline_outer("_faults"))
        .groupBy("_version", "field", "fault")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = F.struct(F.struct("field", "fault").alias("key"), F.col("_n").alias("value"))
    versions = found.groupBy(F.col("_version").alias("schema_version")).agg(
        F.map_from_entries(F.collect_list(counts)).alias("_found")
    )

    def counted_as(number: Column, fault: int) -> Column:
        at = F.struct(number.alias("field"), F.lit(fault).alias("fault"))
        return F.coalesce(F.try_element_at(F.col("_found"), at), F.lit(0)).cast("bigint")

    # One row per proposed field and version.
    fields = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f.name).alias("field")) for i, f in enumerate(proposed)])
    rows = versions.select("schema_version", "_found", F.inline(fields))
    counted = rows.select(
        "schema_version",
        "field",
        counted_as(F.lit(-1), 0).alias("n_rows"),
        counted_as(F.col("i"), _MISSING).alias("n_missing"),
        counted_as(F.col("i"), _NULL).alias("n_null"),
        counted_as(F.col("i"), _MISTYPED).alias("n_mistyped"),
    )
    broken = F.col("n_missing") + F.col("n_null") + F.col("n_mistyped")
    return counted.withColumn("readable", broken == 0)


_MISSING, _NULL, _MISTYPED = 1, 2, 3


def _faults(proposed: list[ProposedField]) -> dict[int, dict[int, Column]]:
    """Per fault and number of a field, whether a record has it; null counts as no."""
    found: dict[int, dict[int, Column]] = {_MISSING: {}, _NULL: {}, _MISTYPED: {}}
    for i, field in enumerate(proposed):
        text = F.col(f"_r.`{field.name}`")
        absent = F.array_contains("_absent", field.name)
        if field.type in _PATTERNS:
            # Patterns, because a failing cast costs many times a failing match.
            found[_MISTYPED][i] = ~text.rlike(_PATTERNS[field.type])
        if not field.nullable:
            found[_NULL][i] = text.isNull() & ~absent
        if not field.has_default:
            found[_MISSING][i] = text.isNull() & absent
    return found


def _listed(numbers: list[int], flags: Column, fault: int) -> Column:
    """The fields whose flag is set, each with the fault."""
    at = F.array_compact(F.transform(flags, lambda flag, i: F.when(flag, i)))
    named = F.array(*map(F.lit, numbers))
    return F.transform(
        at, lambda i: F.struct(F.get(named, i).alias("field"), F.lit(fault).alias("fault"))
    )


def _wrapped_or_plain(pattern: str) -> str:
    """The value as it is, or inside ``{"double": ...}``, there with or without quotes."""
    value = pattern.removeprefix("^").removesuffix("$")
    names = "|".join([*NUMBER_TYPES, "string"])
    return rf'^(?:{value}|\{{"(?:{names})":"?{value}"?\}})$'


_PATTERNS = {"double": _wrapped_or_plain(_NUMBER), "long": _wrapped_or_plain(_WHOLE)}
