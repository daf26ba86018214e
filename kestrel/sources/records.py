"""JSON record extraction and struct flattening.

``extract_records`` applies the envelope precedence to a JSON text column, entirely with
built-in JSON functions (no Python): a top-level array yields its object elements; an
OpenAPI document (``openapi`` and ``paths`` keys) yields nothing; a ``data`` array yields
its objects; a ``data`` object yields itself; otherwise the first value (document order)
that is an array containing objects yields those objects. Each output row carries the
record as JSON text plus its position; ``from_json`` with a schema then types it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _is(variant: Column, kind: str) -> Column:
    return F.startswith(F.schema_of_variant(variant), F.lit(kind))


def _objects(variants: Column) -> Column:
    """The objects among the variants, as JSON text. A string that looks like an object is none."""
    return F.transform(F.filter(variants, lambda v: _is(v, "OBJECT")), lambda v: F.to_json(v))


def _elements(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<variant>")


def record_array(text: Column, allow_openapi: bool = False) -> Column:
    """array<string> of record objects found in a JSON payload (see module doc). What is an array or
    an object is decided by its JSON type, never by how a text begins."""
    empty = F.array().cast("array<string>")
    as_array = F.from_json(text, "array<variant>")
    as_map = F.from_json(text, "map<string,variant>")  # keeps the order of the document
    whole = F.try_parse_json(text)
    data = F.try_element_at(as_map, F.lit("data"))
    lists = F.transform(F.filter(F.map_values(as_map), lambda v: _is(v, "ARRAY")), lambda v: _objects(_elements(v)))
    first_list = F.try_element_at(F.filter(lists, lambda a: F.size(a) > 0), F.lit(1))
    is_openapi = F.map_contains_key(as_map, F.lit("openapi")) & F.map_contains_key(as_map, F.lit("paths"))
    out = F.when(_is(whole, "ARRAY"), _objects(as_array)).when(~_is(whole, "OBJECT") | whole.isNull() | as_map.isNull(), empty)
    if not allow_openapi:
        out = out.when(is_openapi, empty)
    return (out.when(_is(data, "ARRAY"), _objects(_elements(data)))
            .when(_is(data, "OBJECT"), F.array(F.to_json(data)))
            .otherwise(F.coalesce(first_list, empty)))


def extract_records(df: DataFrame, text_col: str, keep: list[str] | None = None,
                    allow_openapi: bool = False) -> DataFrame:
    """One row per record: ``keep`` columns, ``record_no`` (1-based) and ``record`` JSON text."""
    keep = keep or []
    return df.select(*keep, F.posexplode(record_array(F.col(text_col), allow_openapi)).alias("__pos", "record")) \
        .select(*keep, (F.col("__pos") + 1).alias("record_no"), "record")


def type_records(df: DataFrame, schema: StructType | str, record_col: str = "record") -> DataFrame:
    typed = df.withColumn("__r", F.from_json(F.col(record_col), schema))
    return flatten(typed.drop(record_col).withColumnRenamed("__r", "r")).drop("r")


def json_file_records(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Whole-file JSON payloads → typed, flattened records (schema inferred if absent)."""
    files = spark.read.text(path, wholetext=True).withColumn("source_file", F.input_file_name())
    recs = extract_records(files, "value", ["source_file"])
    if schema is None:
        found = recs.select(F.expr("schema_of_variant_agg(try_parse_json(record))").alias("s")).first()["s"]
        schema = found.replace("OBJECT<", "STRUCT<") if found and found.startswith("OBJECT<") else "STRUCT<>"
    return type_records(recs, schema)


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields → top-level columns named with dotted paths; arrays kept."""
    cols: list[Column] = []

    def walk(prefix: list[str], dtype):
        for f in dtype.fields:
            path = prefix + [f.name]
            if isinstance(f.dataType, StructType):
                walk(path, f.dataType)
            else:
                ref = F.col(".".join(f"`{p}`" for p in path))
                name = sep.join(path[1:]) if path[0] == "r" and len(path) > 1 else sep.join(path)
                cols.append(ref.alias(name))

    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            walk([f.name], f.dataType)
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
