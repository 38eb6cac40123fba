"""Typed rows from archived JSON, across schema versions and both JSON encodings.

A nullable field may arrive plain (``"card1": 7.0``) or wrapped with its type name
(``"card1": {"double": 7.0}``); records of both kinds sit in one archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskstream.functions.scalars import null_if_nan, seconds_to_timestamp

# Type names a wrapped number may carry; each widens to double.
NUMBER_TYPES = ["double", "float", "long", "int"]
_WRAPPED = r'"\s*:\s*\{'


def _wrapped_type(kind: T.DataType) -> T.StructType:
    names = ["string"] if isinstance(kind, T.StringType) else NUMBER_TYPES
    return T.StructType([T.StructField(n, kind) for n in names])


def parse(bronze: DataFrame, schema: T.StructType, value: str = "kafka_value") -> DataFrame:
    """Replace ``value`` by the fields of ``schema``.

    Fields match by name, so order does not matter, unknown fields are ignored and
    missing ones are null. Unreadable text gives nulls. ``valid`` says whether every
    required field is present. Each record is read once, and only records with a
    wrapped field are read a second time in that form.
    """
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    wrapped = T.StructType(
        [T.StructField(f.name, _wrapped_type(f.dataType)) for f in schema.fields if f.nullable]
    )
    # NaN arrives as text in plain JSON and is absent by rule.
    text = F.col(value)
    read = bronze.withColumns(
        {
            "_plain": F.from_json(text, plain),
            "_wrapped": F.when(text.rlike(_WRAPPED), F.from_json(text, wrapped)),
        }
    )
    fields = {f.name: _field(f) for f in schema.fields}
    typed = read.select(
        *[c for c in bronze.columns if c != value], *[c.alias(n) for n, c in fields.items()]
    )
    valid = F.lit(True)
    for field in schema.fields:
        if not field.nullable:
            valid = valid & F.col(field.name).isNotNull()
    return typed.withColumn("valid", valid)


def _field(field: T.StructField) -> Column:
    plain = F.col(f"_plain.`{field.name}`")
    if not field.nullable:
        return plain
    names = _wrapped_type(field.dataType).names
    parts = [F.col(f"_wrapped.`{field.name}`.{n}") for n in names]
    both = F.coalesce(*parts, plain)
    return null_if_nan(both) if isinstance(field.dataType, T.DoubleType) else both


def transactions(
    bronze: DataFrame, schema: T.StructType, origin: str = "1970-01-01"
) -> DataFrame:
    """Valid transactions with their event time, keyed by the card in the payload.

    The record key may be salted; the payload's card never is, so whatever groups
    by ``card1`` sees one card as one key. Works on streams.
    """
    typed = parse(bronze.drop("event_time"), schema).where("valid")
    return typed.withColumns(
        {
            "card1": F.col("card1").cast("bigint"),
            "event_time": seconds_to_timestamp(F.col("TransactionDT"), origin),
        }
    )


def parse_versions(
    bronze: DataFrame,
    versions: dict[str, T.StructType],
    default: str,
    version: str = "schema_version",
    value: str = "kafka_value",
) -> DataFrame:
    """Each record read by the schema its ``version`` names, all under one schema.

    Records without a version, or with one not listed, are read by ``default``. Fields a
    version lacks are null; ``valid`` is about the fields the record's own schema requires.

    Every record is read where it stands: all versions are merged into one schema, and a field
    counts in the records whose version has it. A field that changed its type is in one more schema
    for each further type, which only records of those versions are read by.
    """
    numbers = {name: i for i, name in enumerate(versions)}
    known = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    own = F.coalesce(F.try_element_at(known, F.col(version)), F.lit(numbers[default]))
    merged = _Merged(versions)
    text = F.col(value)
    wrapped = text.rlike(_WRAPPED)
    read: dict[str, Column] = {}
    for i, layer in enumerate(merged.layers):
        mine = _among(F.col("_own"), merged.readers[i], len(versions))
        plain = T.StructType([T.StructField(n, t) for n, t in layer.items()])
        nullable = [n for n in layer if merged.nullable[i, n]]
        boxed = T.StructType([T.StructField(n, _wrapped_type(layer[n])) for n in nullable])
        read[f"_plain_{i}"] = F.when(mine, F.from_json(text, plain))
        if nullable:
            read[f"_boxed_{i}"] = F.when(mine & wrapped, F.from_json(text, boxed))
    rows = bronze.withColumn("_own", own).withColumns(read)
    fields = {name: merged.field(name, F.col("_own")) for name in merged.names}
    typed = rows.select(
        *[c for c in bronze.columns if c != value], "_own", *[c.alias(n) for n, c in fields.items()]
    )
    valid = F.lit(True)
    for name, needed in merged.required.items():
        there = F.col(f"`{name}`").isNotNull()
        valid = valid & (~_among(F.col("_own"), needed, len(versions)) | there)
    return typed.withColumn("valid", valid).drop("_own")


class _Merged:
    """All versions in one schema, or in a few where types disagree; versions by number."""

    def __init__(self, versions: dict[str, T.StructType]) -> None:
        self.n = len(versions)
        self.layers: list[dict[str, T.DataType]] = []
        #: versions that use a layer, that have a field there, and that may have it wrapped
        self.readers: list[set[int]] = []
        self.having: dict[tuple[int, str], set[int]] = {}
        self.nullable: dict[tuple[int, str], set[int]] = {}
        self.required: dict[str, set[int]] = {}
        for number, schema in enumerate(versions.values()):
            for field in schema.fields:
                self._add(number, field)
        self.names = list(dict.fromkeys(n for layer in self.layers for n in layer))

    def _add(self, number: int, field: T.StructField) -> None:
        name = field.name
        for i, layer in enumerate(self.layers):
            if layer.setdefault(name, field.dataType) == field.dataType:
                break
        else:
            i = len(self.layers)
            self.layers.append({name: field.dataType})
            self.readers.append(set())
        self.readers[i].add(number)
        self.having.setdefault((i, name), set()).add(number)
        may = self.nullable.setdefault((i, name), set())
        if field.nullable:
            may.add(number)
        else:
            self.required.setdefault(name, set()).add(number)

    def field(self, name: str, own: Column) -> Column:
        parts = []
        for i, layer in enumerate(self.layers):
            if name not in layer:
                continue
            plain = F.col(f"_plain_{i}.`{name}`")
            value = plain
            if may := self.nullable[i, name]:
                kinds = _wrapped_type(layer[name]).names
                boxed = F.coalesce(*[F.col(f"_boxed_{i}.`{name}`.{k}") for k in kinds], plain)
                boxed = null_if_nan(boxed) if isinstance(layer[name], T.DoubleType) else boxed
                everywhere = may >= self.having[i, name]
                value = boxed if everywhere else F.when(_among(own, may, self.n), boxed).otherwise(plain)
            having = self.having[i, name]
            whole = having >= self.readers[i]
            parts.append(value if whole else F.when(_among(own, having, self.n), value))
        kinds = {layer[name] for layer in self.layers if name in layer}
        if len(kinds) > 1 and T.StringType() in kinds:  # text and numbers meet as text
            parts = [part.cast("string") for part in parts]
        return F.coalesce(*parts)


def _among(own: Column, numbers: set[int], n: int) -> Column:
    return F.lit(True) if len(numbers) == n else own.isin(sorted(numbers))


def union_versions(*versions: DataFrame) -> DataFrame:
    """Rows of several schema versions under one schema; fields a version lacks are null."""
    merged = versions[0]
    for version in versions[1:]:
        merged = merged.unionByName(version, allowMissingColumns=True)
    return merged
