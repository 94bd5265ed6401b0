"""Raw JSON documents without loss: every field and every number, whatever a schema foresaw.

Lines are parsed once, into VARIANT, which holds a document as it came. Typed columns are taken
from there: a number is read as a number however it is spelled (``5``, ``5.0``, ``"5"``) and then
cast, and what does not fit a type makes only its own field NULL."""

from __future__ import annotations

import json
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    DoubleType,
    MapType,
    NullType,
    NumericType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tidemark.functions.naming import aliased, quoted, require_distinct
from tidemark.functions.schemas import united
from tidemark.sources.files import discard, read_text, write_text
from tidemark.sources.staging import staging_path

_DOCUMENT = "__document"
_LINE = "__line"
_BRACE = r"^[ \t\r\n]*\{"
#: Whether Parquet files hold frequent fields of a VARIANT in columns of their own.
_SHREDDING = "spark.sql.variant.inferShreddingSchema"


def _learned(data_type: DataType) -> DataType:
    """The type a column gets for what was found in documents: numbers with a fraction or beyond
    a long are doubles; what has no one type stays as it came, as text."""
    if isinstance(data_type, StructType):
        return StructType([StructField(field.name, _learned(field.dataType)) for field in data_type])
    if isinstance(data_type, ArrayType):
        return ArrayType(_learned(data_type.elementType))
    if isinstance(data_type, DecimalType):
        return DoubleType()
    return StringType() if isinstance(data_type, VariantType) else data_type


def _either(old: DataType, new: DataType) -> DataType:
    """What two batches' types have in common: doubles for numbers, else text."""
    both = isinstance(old, NumericType) and isinstance(new, NumericType)
    return DoubleType() if both else StringType()


def _readable(data_type: DataType, declared: DataType | None) -> DataType:
    """``data_type`` with the declared types of single values and of what has no one type, and the
    declared fields that no document had; text where there was never anything but NULL. A struct
    or array stays one where a single value is declared, as type variants are structs."""
    if isinstance(data_type, StructType):
        own = {f.name: f.dataType for f in declared} if isinstance(declared, StructType) else {}
        fields = [StructField(f.name, _readable(f.dataType, own.pop(f.name, None))) for f in data_type]
        return StructType(fields + [StructField(name, kind) for name, kind in own.items()])
    if isinstance(data_type, ArrayType):
        element = declared.elementType if isinstance(declared, ArrayType) else None
        return ArrayType(_readable(data_type.elementType, element))
    if declared is not None:
        return declared
    return StringType() if isinstance(data_type, NullType) else data_type


def _narrowed(schema: StructType, only: Mapping[str, Collection[str]]) -> StructType:
    """``schema`` with some fields of the structs that ``only`` names; those without any stay."""
    def kept(field: StructField) -> StructField:
        if field.name not in only or not isinstance(field.dataType, StructType):
            return field
        some = [f for f in field.dataType if f.name in only[field.name]]
        return StructField(field.name, StructType(some)) if some else field

    return StructType([kept(field) for field in schema])


def schema_of(text: str | None) -> StructType:
    """The struct that ``schema_of_variant_agg`` describes."""
    if text is None or not text.startswith("OBJECT<"):
        return StructType([])
    found = DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    return _learned(found) if isinstance(found, StructType) else StructType([])


def _ddl(data_type: DataType) -> str:
    """A type as SQL text, with all field names quoted."""
    if isinstance(data_type, StructType):
        return f"struct<{', '.join(f'{quoted(f.name)}: {_ddl(f.dataType)}' for f in data_type)}>"
    if isinstance(data_type, ArrayType):
        return f"array<{_ddl(data_type.elementType)}>"
    if isinstance(data_type, MapType):
        return f"map<{_ddl(data_type.keyType)}, {_ddl(data_type.valueType)}>"
    return data_type.simpleString()


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _field(document: str, field: StructField) -> str:
    at = _text('$["' + field.name.replace('"', '\\"') + '"]')
    return aliased(f"try_variant_get({quoted(document)}, {at}, {_text(_ddl(field.dataType))})", field.name)


def typed(df: DataFrame, document: str, schema: StructType) -> DataFrame:
    """The fields of ``schema`` as columns, from a VARIANT column. Each is taken by its own path,
    so a query that needs few fields takes only those from the document."""
    require_distinct(df, schema.names)
    return df.selectExpr(*(_field(document, field) for field in schema))


def parse_documents(df: DataFrame, text: Column, schema: StructType, rest: str | None = None) -> DataFrame:
    """Documents held as JSON text, as the columns of a declared schema, with numbers as
    :func:`landed` reads them. ``rest`` names a column for the whole document as VARIANT, so that
    what the schema does not foresee is not lost, as a stream needs it, whose schema cannot
    follow the documents. Text that is no JSON gives NULLs."""
    parsed = df.select(F.try_parse_json(text).alias(_DOCUMENT))
    more = [] if rest is None else [aliased(quoted(_DOCUMENT), rest)]
    return parsed.selectExpr(*(_field(_DOCUMENT, field) for field in schema), *more)


@dataclass(frozen=True)
class Landed:
    """A batch of documents."""

    #: Every field that this batch or an earlier one has, as a column.
    documents: DataFrame
    #: Lines that are no JSON objects, as they came.
    malformed: DataFrame
    #: Fields of this batch alone.
    found: StructType


@contextmanager
def _whole_variants(spark: SparkSession) -> Iterator[None]:
    """Documents are written as they are, as long as the block lasts: to take them apart by fields
    costs more than the few reads of staged documents save."""
    before = spark.conf.get(_SHREDDING, None)
    spark.conf.set(_SHREDDING, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHREDDING)
        else:
            spark.conf.set(_SHREDDING, before)


@contextmanager
def landed(lines: DataFrame, declared: StructType | None = None, store: str | None = None,
           only: Mapping[str, Collection[str]] | None = None) -> Iterator[Landed]:
    """A batch of JSON lines (a frame of one text column, as ``spark.read.text`` gives it), staged
    for as long as the block lasts.

    The one pass that parses the lines also finds their schema, and stages the documents as
    VARIANT. With ``store``, the path of a small file, the fields of this batch are added to those
    of all batches before, and the union is stored; so a batch without some field still has its
    column, and no run has to look at old files. Of numbers in several types doubles are made, of
    other differences text. Fields of ``declared`` are always there, and where they hold single
    values, or values that have no one type, they have the types it states. ``only`` names fields
    of top-level structs that a reader is content with; the others of these are not taken from the
    documents, which costs something for each."""
    spark = lines.sparkSession
    text = F.col(quoted(lines.columns[0]))
    parsed = lines.where(F.length(F.trim(text)) > 0).select(F.try_parse_json(text).alias(_DOCUMENT), text.alias(_LINE))
    # Text that parses and begins with a brace is an object; only of others is the type looked up.
    is_object = (
        F.when(F.col(_DOCUMENT).isNull(), False).when(F.col(_LINE).rlike(_BRACE), True)
        .otherwise(F.startswith(F.expr(f"schema_of_variant({_DOCUMENT})"), F.lit("OBJECT")))
    )
    parsed = parsed.select(
        F.when(is_object, F.col(_DOCUMENT)).alias(_DOCUMENT), F.when(~is_object, F.col(_LINE)).alias(_LINE)
    )
    path = staging_path(spark, "documents")
    observation = Observation()
    try:
        observed = parsed.observe(observation, F.expr(f"schema_of_variant_agg({_DOCUMENT})").alias("schema"))
        with _whole_variants(spark):
            observed.write.parquet(path)
        found = schema_of(observation.get["schema"])
        known = found
        if store is not None:
            held = read_text(spark, store)
            if held is not None:
                known = united(StructType.fromJson(json.loads(held)), found, key=str, otherwise=_either)
            if held is None or known.json() != held:
                write_text(spark, store, known.json())
        staged = spark.read.schema(parsed.schema).parquet(path)
        objects = staged.where(F.col(_DOCUMENT).isNotNull())
        yield Landed(
            typed(objects, _DOCUMENT, _narrowed(_readable(known, declared), only or {})),
            staged.where(F.col(_LINE).isNotNull()).select(F.col(_LINE).alias("line")), found,
        )
    finally:
        discard(spark, path)
