"""JSON text columns read as variants: fields found in the data, typed, and odd rows kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_NUMBERS = ("BIGINT", "DOUBLE")
_SCALARS = (*_NUMBERS, "STRING", "BOOLEAN", "DATE", "TIMESTAMP")


def _parsed(df: DataFrame, column: str) -> DataFrame:
    variant = F.try_parse_json(column)
    return df.withColumn("_json", F.when(F.schema_of_variant(variant).startswith("OBJECT"), variant))


def fields_of(df: DataFrame, column: str, share: float = 0.05) -> dict[str, str]:
    """Top-level fields of the objects in a JSON column and their types, by name, in one pass.

    A field, and a type of it, counts if at least ``share`` of the objects have it, so that odd rows
    neither add fields nor change types; that also bounds how many the driver gets. Whole and
    broken numbers make a double, other mixed types a string; objects and arrays stay variants.
    Objects without any field are not counted.
    """
    objects = _parsed(df, column).where(F.col("_json").isNotNull()).select("_json")
    inside = df.sparkSession.tvf.variant_explode(F.col("_json").outer())
    kind = F.regexp_replace(F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0), "DECIMAL|FLOAT", "DOUBLE")
    found = objects.lateralJoin(inside).select(
        # An empty place marks an object, so that objects are counted in the pass that counts fields.
        F.explode(
            F.when(F.col("pos") == 0, F.array(F.struct("key", kind.alias("kind")), F.lit(None))).otherwise(
                F.array(F.struct("key", kind.alias("kind")))
            )
        ).alias("field")
    )
    counted = found.groupBy("field.key", "field.kind").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum(F.when(F.col("key").isNull(), F.col("n")))
    counted = counted.persist()
    try:
        objects_seen = counted.agg(total).first()[0] or 0
        often = counted.where("key IS NOT NULL AND kind <> 'VOID'").where(F.col("n") >= share * objects_seen).collect()
    finally:
        counted.unpersist()
    kinds: dict[str, set[str]] = {}
    for row in often:
        kinds.setdefault(row["key"], set()).add(row["kind"])
    return {key: _common(kinds[key]) for key in sorted(kinds)}


def _common(kinds: set[str]) -> str:
    if len(kinds) == 1:
        (kind,) = kinds
        return kind.lower() if kind in _SCALARS else "variant"
    return "double" if kinds <= set(_NUMBERS) else "string"


def shredded(df: DataFrame, column: str, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose text is a JSON object, with a column for each field, and the rows where it is not.

    Fields that a row lacks or holds in another type are NULL. Both keep the columns of ``df``; rows
    with a NULL text are among the second.
    """
    parsed = _parsed(df, column)
    paths = {key: F.try_variant_get("_json", _path(key), kind) for key, kind in fields.items()}
    good = parsed.where(F.col("_json").isNotNull()).withColumns(paths).drop("_json")
    return good, parsed.where(F.col("_json").isNull()).drop("_json")


def _path(key: str) -> str:
    quote = '"' if "'" in key else "'"
    return f"$[{quote}{key}{quote}]"
