"""JSON columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_array_rows(df: DataFrame, json_col: str, time_col: str, keep=()) -> DataFrame:
    """a JSON array of objects -> the distinct (time, object) rows, one
    row per object entry ``(…keep, access_time, key, value, value_num)``.

    Text that is not a JSON array gives no rows.  Values are kept as text;
    ``value_num`` is the number when the text is one (the reference turns
    JSON numbers into doubles).
    """
    arr = F.from_json(F.col(json_col), "array<map<string,string>>")
    objs = (df.select(*keep, F.col(time_col).alias("access_time"), F.explode(arr).alias("obj"))
            .withColumn("_obj_text", F.to_json("obj")))
    # maps are not comparable in Spark: distinct on their JSON text
    distinct = objs.dropDuplicates([*keep, "access_time", "_obj_text"])
    return (distinct.select(*keep, "access_time", F.explode("obj").alias("key", "value"))
            .withColumn("value_num", F.col("value").try_cast("double")))


#: Kinds of JSON values by the first word of their variant schema; every other one is a number.
_KINDS = {"STRING": "string", "BOOLEAN": "boolean", "VOID": "null", "ARRAY": "array", "OBJECT": "object"}


def json_typed_rows(df: DataFrame, json_col: str, time_col: str, keep=()) -> DataFrame:
    """F14 with typed values: a JSON array of objects -> the distinct (time, object) rows, one row per entry
    ``(*keep, access_time, key, kind, number, flag, text)``.

    ``kind`` is the value's JSON type; a number is in ``number`` (as a double), a boolean in ``flag``, a string,
    or the JSON text of an array or object, in ``text``; null has none of them.  Objects are the same when their
    typed entries are, whatever their order or spelling: 1 and 1.0, but not 1 and "1".  Text that is no JSON array
    gives no rows, nor do array members that are no objects.  Parsed once, as VARIANT.
    """
    parsed = df.select(*keep, F.col(time_col).alias("access_time"), F.try_parse_json(F.col(json_col)).alias("_v"))
    objs = parsed.select(*keep, "access_time", F.explode(F.try_variant_get("_v", "$", "array<variant>")).alias("_o"))
    entries = objs.select(*keep, "access_time", F.map_entries(F.try_variant_get("_o", "$", "map<string,variant>")).alias("_e"))

    def typed(e):
        v = e["value"]
        first = F.regexp_extract(F.coalesce(F.schema_of_variant(v), F.lit("VOID")), "^[A-Z]+", 0)
        kind = F.lit("number")
        for word, name in _KINDS.items():
            kind = F.when(first == word, name).otherwise(kind)
        # + 0.0: one zero
        return F.struct(e["key"].alias("key"), kind.alias("kind"), F.when(kind == "number", F.try_variant_get(v, "$", "double") + F.lit(0.0)).alias("number"),
                        F.when(kind == "boolean", F.try_variant_get(v, "$", "boolean")).alias("flag"),
                        F.when(kind == "string", F.try_variant_get(v, "$", "string")).when(kind.isin("array", "object"), F.to_json(v)).alias("text"))
    rows = entries.select(*keep, "access_time", F.array_sort(F.transform("_e", typed)).alias("_e")).dropDuplicates()
    return rows.select(*keep, "access_time", F.explode("_e").alias("_e")).select(*keep, "access_time", "_e.*")


def to_json_text(*cols) -> Column:
    """an object as JSON text; a null object -> ''.

    The columns are the object's fields (names as keys, in order); an object
    without any value is null.  ``struct_to_json_text`` takes a struct column.
    """
    fields = [F.col(c) if isinstance(c, str) else c for c in cols]
    any_value = F.coalesce(*[F.when(f.isNotNull(), F.lit(True)) for f in fields])
    return F.when(any_value, F.to_json(F.struct(*fields))).otherwise(F.lit(""))


def struct_to_json_text(c) -> Column:
    """F15 for one struct, map or array column."""
    return F.coalesce(F.to_json(c), F.lit(""))
