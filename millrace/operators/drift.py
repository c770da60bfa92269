"""Schema drift: which paths the bodies really have, against the declared columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

LEVELS = 4  # tried first; twice as many where a body is deeper
MALFORMED = "malformed"
COUNTS = "path string, parent string, kind string, n_values long"
DECLARED = "path string, parent string, declared string"
KINDS = {  # of the declared types
    T.StructType: "object",
    T.ArrayType: "array",
    T.StringType: "string",
    T.TimestampType: "string",
    T.DateType: "string",
    T.BooleanType: "boolean",
    T.IntegralType: "integer",
    T.FractionalType: "number",
}


def declared_paths(schema: T.DataType, path: str = "$", parent: str | None = None) -> list[tuple]:
    """(path, parent, kind) of a type and all that it holds; `$.a[].b` is b in the elements of a."""
    kind = next((name for of, name in KINDS.items() if isinstance(schema, of)), None)
    if kind is None:
        raise ValueError(f"{path}: no JSON kind stands for {schema.simpleString()}")
    inner = []
    if isinstance(schema, T.StructType):
        inner = [(f"{path}.{_quoted(f.name)}", f.dataType) for f in schema.fields]
    elif isinstance(schema, T.ArrayType):
        inner = [(f"{path}[]", schema.elementType)]
    return [(path, parent, kind), *(row for at, of in inner for row in declared_paths(of, at, path))]


def _plain(name: str) -> bool:
    return name.isascii() and name.replace("_", "a").isalnum() and not name[0].isdigit()


def _quoted(name: str) -> str:
    return name if name and _plain(name) else f'"{name}"'


def _leaf_kind(value: Column) -> Column:
    """The kind of a value without children."""
    of = F.schema_of_variant(value)
    return (
        F.when(of == "VOID", "null")
        .when(of == "BIGINT", "integer")
        .when(of.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .when(of.startswith("DECIMAL") | (of == "DOUBLE"), "number")
        .when(of.startswith("OBJECT"), "object")
        .when(of.startswith("ARRAY"), "array")
        .otherwise(F.lower(of))
    )


def _opened(values: DataFrame) -> DataFrame:
    """One level further down: a row per child, or the row itself where there is none.

    `seen` are the values on the way down that no row before has told of: a child that isn't its
    parent's first leaves the parent, and all above it, to the first.
    """
    tvf = values.sparkSession.tvf
    rows = values.lateralJoin(tvf.variant_explode_outer(F.col("at").outer()))
    kind = F.when(F.col("key").isNotNull(), "object").when(F.col("pos").isNotNull(), "array")
    entry = F.struct("path", "parent", kind.otherwise(_leaf_kind(F.col("at"))).alias("kind"))
    seen = F.when(F.col("path").isNull(), F.col("seen")).otherwise(F.concat("seen", F.array(entry)))
    name = F.when(F.col("key").rlike(r"^[A-Za-z_][A-Za-z0-9_]*$"), F.col("key")).otherwise(
        F.concat(F.lit('"'), F.col("key"), F.lit('"'))
    )
    step = F.when(F.col("key").isNotNull(), F.concat(F.lit("."), name)).when(F.col("pos").isNotNull(), "[]")
    return rows.select(
        F.concat("path", step).alias("path"),
        F.when(step.isNotNull(), F.col("path")).alias("parent"),
        F.when(F.coalesce("pos", F.lit(0)) == 0, seen).otherwise(F.slice(seen, 1, 0)).alias("seen"),
        F.col("value").alias("at"),
    )


def path_counts(bodies: DataFrame, body: str = "body", levels: int = LEVELS) -> DataFrame:
    """(path, parent, kind, n_values): how often each path holds each kind of value. Mergeable: sums add up.

    Kinds are object, array, string, integer, number, boolean and null; a number without a fraction
    is an integer, unless it has an exponent. A body that is no JSON, or repeats a key in one object, counts
    as malformed, at `$`. NULL bodies are left out. Odd keys are quoted: `$."a.b"`.

    Each body is parsed once and opened level by level within its map task; only counts are
    shuffled, with partial counts before. Bodies deeper than `levels` are counted in a second pass
    over all, with twice as many.
    """
    parsed = F.try_parse_json(F.col(body)).alias("at")
    none = F.array().cast("array<struct<path string, parent string, kind string>>").alias("seen")
    start = bodies.where(F.col(body).isNotNull()).select(
        F.lit("$").alias("path"), F.lit(None).cast("string").alias("parent"), none, parsed
    )
    bad = F.array(F.struct("path", "parent", F.lit(MALFORMED).alias("kind")))
    start = start.withColumns({
        "seen": F.when(F.col("at").isNull(), bad).otherwise(F.col("seen")),
        "path": F.when(F.col("at").isNotNull(), F.col("path")),
    })
    opened = reduce(lambda rows, _: _opened(rows), range(levels), start)
    unnamed = F.lit(None).cast("string")
    deeper = F.struct(unnamed.alias("path"), unnamed.alias("parent"), F.lit("deeper").alias("kind"))
    told = F.when(F.col("at").isNull(), F.col("seen")).otherwise(F.concat("seen", F.array(deeper)))
    counts = opened.select(F.explode(told).alias("e")).groupBy("e.path", "e.parent", "e.kind")
    counts = stage(counts.agg(F.count(F.lit(1)).alias("n_values")))
    if counts.where("path IS NULL").isEmpty():
        return counts
    return path_counts(bodies, body, 2 * levels)


def drift_report(counts: DataFrame, schema: T.DataType) -> DataFrame:
    """(path, status, declared, kind, n_values, n_absent): a row per path and kind of `path_counts`.

    status: `declared`; `retyped` where the kind is not the declared one (a null is of any kind, an
    integer also a number); `new` for a path that is not declared; `missing`, without a kind, for a
    declared path that no body has; `malformed` for the bodies without any. `n_absent`: the objects that
    could hold the path and don't; NULL for `$` and for elements.
    """
    spark: SparkSession = counts.sparkSession
    counts = counts.groupBy("path", "parent", "kind").agg(F.sum("n_values").alias("n_values"))
    declared = spark.createDataFrame(declared_paths(schema), DECLARED)
    objects = counts.where("kind = 'object'").select(F.col("path").alias("parent"), F.col("n_values").alias("_holders"))
    present = counts.where(F.col("kind") != MALFORMED).groupBy("path").agg(F.sum("n_values").alias("_present"))
    rows = counts.join(declared.withColumnRenamed("parent", "_parent"), "path", "full")
    rows = rows.withColumn("parent", F.coalesce("parent", "_parent"))
    rows = rows.join(present, "path", "left").join(objects, "parent", "left")
    fits = F.col("kind").isin("null") | (F.col("kind") == F.col("declared"))
    fits |= (F.col("kind") == "integer") & (F.col("declared") == "number")
    status = (
        F.when(F.col("kind") == MALFORMED, MALFORMED)
        .when(F.col("kind").isNull(), "missing")
        .when(F.col("declared").isNull(), "new")
        .when(fits, "declared")
        .otherwise("retyped")
    )
    absent = F.coalesce("_holders", F.lit(0)) - F.coalesce("_present", F.lit(0))
    member = F.col("parent").isNotNull() & ~F.col("path").endswith("[]")
    return rows.select(
        "path",
        status.alias("status"),
        "declared",
        "kind",
        F.coalesce("n_values", F.lit(0)).cast("bigint").alias("n_values"),
        F.when(member, absent).cast("bigint").alias("n_absent"),
    )
