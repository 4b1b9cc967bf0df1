"""JSON payloads whose shape drifts: typed columns, and a report of what the declared schema does not say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

#: kinds of JSON values that a declared type takes; a JSON null fits all
TAKES = {"string": ("STRING",), "boolean": ("BOOLEAN",), "struct": ("OBJECT",), "array": ("ARRAY",), "map": ("OBJECT",),
         **dict.fromkeys(("byte", "short", "integer", "long"), ("BIGINT",)),
         **dict.fromkeys(("float", "double", "decimal"), ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"))}
NULL = "VOID"


def _schema(declared: StructType | str) -> StructType:
    return StructType.fromDDL(declared) if isinstance(declared, str) else declared


def _step(name: str) -> str:
    """A field of a variant path, of any name but one with both kinds of quotes."""
    return f'["{name}"]' if '"' not in name else f"['{name}']"


def typed(df: DataFrame, column: str, declared: StructType | str) -> DataFrame:
    """``df`` with the declared fields of the JSON text ``column`` as columns in its place.

    The text is parsed once. Text that is not JSON, absent fields and values of
    another type are NULL; numbers in text are read as numbers.
    """
    fields = _schema(declared).fields
    clash = {f.name.lower() for f in fields} & {c.lower() for c in df.columns if c != column}
    if clash:
        raise ValueError(f"columns of these names are there already: {sorted(clash)}")
    parsed = df.withColumn(column, F.try_parse_json(column))
    return parsed.select(*[c for c in df.columns if c != column],
                         *[F.try_variant_get(column, "$" + _step(f.name), f.dataType.simpleString()).alias(f.name) for f in fields])


def _structs(schema: StructType, path: str, steps: str) -> list[tuple[str, str, StructType]]:
    """The payload and every declared struct inside it: shown path, variant path, schema."""
    out = [(path, steps, schema)]
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            out += _structs(f.dataType, f"{path}.{f.name}", steps + _step(f.name))
    return out


def _fields(path: str, values: Column) -> Column:
    """(at, name, kind) of the fields of an object; none if it is not one."""
    named = F.transform(F.map_entries(values), lambda e: F.struct(
        F.lit(path).alias("at"), e["key"].alias("name"), F.regexp_extract(F.schema_of_variant(e["value"]), "^[A-Z]+", 0).alias("kind")))
    return F.coalesce(named, F.array().cast("array<struct<at:string,name:string,kind:string>>"))


def _judged(kind: Column, declared: DataType | None) -> Column:
    if declared is None:
        return F.lit("undeclared")
    fits = kind.isin(*TAKES.get(declared.typeName(), ()), NULL)
    return F.when(fits, F.lit("as_declared")).otherwise(F.lit("other_type"))


def drift(df: DataFrame, column: str, declared: StructType | str) -> DataFrame:
    """What the JSON texts hold against what is declared: (path, kind, state, n_rows).

    ``state`` is ``as_declared``, ``other_type``, ``undeclared``, ``absent`` (declared, but in no row) or ``broken`` (path
    ``$``, text that is not JSON). Undeclared objects are reported whole. NULL texts do not count. The texts are parsed
    once; each row gives one pair per field, which is counted before the shuffle, and only names and kinds are grouped.
    """
    schema = _schema(declared)
    parsed = df.where(F.col(column).isNotNull()).select(F.try_parse_json(column).alias("v"))
    found, judged = [F.array(F.when(F.col("v").isNull(), F.struct(F.lit("$").alias("at"), F.lit("").alias("name"), F.lit("").alias("kind"))))], []
    for path, steps, part in _structs(schema, "$", "$"):
        found.append(_fields(path, F.try_variant_get("v", steps, "map<string,variant>")))
        judged += [(path, f.name, f.dataType) for f in part.fields]
    # generated from one column, so that the text is parsed once per row and not once per level
    pairs = parsed.select(F.explode(F.filter(F.concat(*found), lambda p: p.isNotNull())).alias("p"))
    counts = pairs.groupBy("p.at", "p.name", "p.kind").agg(F.count(F.lit(1)).alias("n_rows"))
    known = [F.when((F.col("at") == at) & (F.col("name") == name), _judged(F.col("kind"), dtype)) for at, name, dtype in judged]
    state = F.when(F.col("kind") == "", F.lit("broken")).otherwise(F.coalesce(*known, F.lit("undeclared")))
    shown = F.when(F.col("kind") == "", F.col("at")).otherwise(F.concat_ws(".", "at", "name"))
    seen = counts.select(shown.alias("path"), "kind", state.alias("state"), "n_rows")
    return seen.unionByName(_absent(seen, [f"{at}.{name}" for at, name, _ in judged]))


def _absent(seen: DataFrame, paths: list[str]) -> DataFrame:
    """Declared paths that no row has."""
    if not paths:
        return seen.limit(0)
    # one row of names decides, so the texts are not held against each path again
    there = seen.where(F.col("path").isin(paths)).agg(F.collect_set("path").alias("there"))
    missing = F.array_except(F.array(*map(F.lit, paths)), "there")
    return there.select(F.explode(missing).alias("path")).select(
        "path", F.lit("").alias("kind"), F.lit("absent").alias("state"), F.lit(0).cast("long").alias("n_rows"))
