"""Which values of a landed line do not fit the fields they stand in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _present(value: Column) -> Column:
    return value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))


# Kinds of JSON values, as variants name them, that the JSON reader takes for a type; any for text.
_KINDS = {
    T.BooleanType: "BOOLEAN", T.ByteType: "BIGINT", T.ShortType: "BIGINT", T.IntegerType: "BIGINT", T.LongType: "BIGINT",
    T.FloatType: "BIGINT|DECIMAL.*|DOUBLE|FLOAT", T.DoubleType: "BIGINT|DECIMAL.*|DOUBLE|FLOAT", T.DecimalType: "BIGINT|DECIMAL.*|DOUBLE|FLOAT",
}


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a present value is of a kind that the field's type takes, and within its range."""
    if isinstance(kind, T.StringType):
        return F.lit(True)
    cast = F.try_variant_get(value, "$", kind.simpleString()).isNotNull()
    kinds = _KINDS.get(type(kind))
    return cast if kinds is None else cast & F.schema_of_variant(value).rlike(f"^({kinds})$")


def misfits(value: Column, kind: T.DataType, path: str = "") -> list[tuple[str, Column]]:
    """(field, how often a value is present there but does not fit) for every leaf of ``kind`` below a variant, and for
    structs and arrays that are something else."""
    if isinstance(kind, T.StructType):
        members = F.try_variant_get(value, "$", "map<string,variant>")
        inside = [
            pair
            for f in kind
            for pair in misfits(F.try_element_at(members, F.lit(f.name)), f.dataType, f"{path}.{f.name}" if path else f.name)
        ]
        return [(path or "$", F.when(_present(value) & members.isNull(), 1).otherwise(0)), *inside]
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        names = [name for name, _ in misfits(F.lit(None), kind.elementType, f"{path}[]")]

        def total(i: int) -> Column:
            def add(sum_, item):
                return sum_ + misfits(item, kind.elementType, f"{path}[]")[i][1]

            return F.aggregate(F.coalesce(items, F.array().cast("array<variant>")), F.lit(0), add)

        wrong = F.when(_present(value) & items.isNull(), 1).otherwise(0)
        return [(path, wrong), *((name, total(i)) for i, name in enumerate(names))]
    if isinstance(kind, T.MapType):
        members = F.try_variant_get(value, "$", "map<string,variant>")
        return [(path, F.when(_present(value) & members.isNull(), 1).otherwise(0))]
    return [(path, F.when(_present(value) & ~_fits(value, kind), 1).otherwise(0))]


def misfit_counts(text: Column | str, schema: str) -> Column:
    """Map from field to the number of its values in a JSON line that do not fit, only fields that have some. A line that
    is no JSON at all gives an empty map."""
    line = F.try_parse_json(text)
    found = misfits(line, T.StructType.fromDDL(schema))
    pairs = F.array(*(F.struct(F.lit(name).alias("field"), n.cast("long").alias("n")) for name, n in found))
    return F.map_from_entries(F.filter(pairs, lambda p: p["n"] > 0))


def count_misfits(lines: DataFrame, column: str = "misfits") -> dict[str, int]:
    """Sums by field over all lines: a row per field of the schema at most."""
    rows = lines.select(F.explode(column).alias("field", "n")).groupBy("field").agg(F.sum("n").alias("n")).collect()
    return {row["field"]: row["n"] for row in sorted(rows)}
