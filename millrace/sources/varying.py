"""JSON lines whose fields change their types from row to row.

Lines are parsed once into the variant type, which keeps every value as it is. Declared fields are taken from it where
their values are of the declared kind; everything else of the line stays in one column, so nothing is lost and
nothing is turned into something else without being asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from millrace.sources.readers import read_text

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_ANY_NUMBER = (DoubleType, FloatType, DecimalType)


def _kind(value: Column) -> Column:
    """What a JSON value is, without the digits of a decimal and without what stands inside of arrays and objects."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)


def _fits(value: Column, kind: DataType, name: str) -> Column:
    """Whether a value that is there is of the declared kind, and can be held by it."""
    if isinstance(kind, StringType):
        return _kind(value) == "STRING"
    if isinstance(kind, BooleanType):
        return _kind(value) == "BOOLEAN"
    held = F.try_variant_get(value, "$", kind.simpleString()).isNotNull()
    if isinstance(kind, _WHOLE):
        return (_kind(value) == "BIGINT") & held
    if isinstance(kind, _ANY_NUMBER):
        return _kind(value).isin("BIGINT", "DECIMAL", "DOUBLE") & held
    return held


def varying_fields(lines: DataFrame, col: str = "value") -> StructType:
    """The fields of all lines; one that has values of several kinds is a variant. One pass over the lines."""
    parsed = F.try_parse_json(col)
    whole = lines.select(F.when(_kind(parsed) == "OBJECT", parsed).alias("v")).agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not whole or not whole.startswith("OBJECT<"):
        return StructType()
    return StructType.fromDDL(_as_ddl(whole)[len("STRUCT<") : -1])


def _as_ddl(told: str) -> str:
    return told.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")


def typed_json(lines: DataFrame, schema: StructType | str, col: str = "value", rest: str = "rest", bad: str = "bad") -> DataFrame:
    """The declared fields of JSON lines, and what else there is in them.

    A field is null where the line does not have it, has ``null`` there, or a value of another kind: text for a number, a
    number for text, a fraction for a whole number, a number out of range. ``rest`` maps the names of such values, and of
    all fields that are not declared, to their JSON text; it is empty where all fits. A line that is not a JSON object
    has nulls, an empty ``rest`` and itself in ``bad``, which is null elsewhere. A variant field takes any value.
    """
    fields = (schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).fields
    clash = {f.name for f in fields} & {rest, bad}
    if clash:
        raise ValueError(f"{', '.join(sorted(clash))}: choose other names for what does not fit")
    parsed = F.try_parse_json(F.col(col))
    rows = lines.select(F.col(col).alias("_line"), parsed.alias("_whole"))
    rows = rows.withColumn("_object", F.when(_kind(F.col("_whole")) == "OBJECT", F.col("_whole").try_cast("map<string, variant>")))
    values = rows.select("_line", "_object", *[F.try_element_at("_object", F.lit(f.name)).alias(f"_v{i}") for i, f in enumerate(fields)])

    def there(i: int) -> Column:
        return F.col(f"_v{i}").isNotNull() & ~F.is_variant_null(F.col(f"_v{i}"))

    def taken(i: int, f: StructField) -> Column:
        value = F.col(f"_v{i}")
        if f.dataType.simpleString() == "variant":
            return value
        return F.when(there(i) & _fits(value, f.dataType, f.name), F.try_variant_get(value, "$", f.dataType.simpleString()))

    def misfits(i: int, f: StructField) -> Column:
        if f.dataType.simpleString() == "variant":
            return F.lit(False)
        return F.coalesce(there(i) & ~_fits(F.col(f"_v{i}"), f.dataType, f.name), F.lit(False))

    marked = values.withColumn("_misfits", F.array_compact(F.array(F.lit(""), *[F.when(misfits(i, f), F.lit(f.name)) for i, f in enumerate(fields)])))
    declared = F.array(*[F.lit(f.name) for f in fields]) if fields else F.array(F.lit("")).cast("array<string>")
    left = F.map_filter("_object", lambda k, v: ~F.array_contains(declared, k) | F.array_contains(F.col("_misfits"), k))
    as_text = F.transform_values(left, lambda _, v: F.to_json(v))
    nothing = F.create_map().cast("map<string, string>")
    return marked.select(
        *[taken(i, f).alias(f.name) for i, f in enumerate(fields)],
        F.coalesce(as_text, nothing).alias(rest),
        F.when(F.col("_object").isNull(), F.col("_line")).alias(bad),
    )


def read_varying_json(spark: SparkSession, path: str, schema: StructType | str | None = None, **names: str) -> DataFrame:
    """JSON lines by a declared schema, see ``typed_json``; without one the lines are read once more for their fields."""
    lines = read_text(spark, path)
    return typed_json(lines, varying_fields(lines) if schema is None else schema, **names)
