"""Types of all-string columns, found in one pass.

``spark.read`` with ``inferSchema`` reads the text once more, gives one answer a column and
says nothing about why.  Here each value of an all-string scan is put in a class
(boolean, long, double, date, timestamp or text).  Rows are counted by the classes of a block
of columns at once: different combinations are few, and only they are taken apart into
counts per column and class.  The type of a column is the least one of the lattice

    boolean    long < double    date < timestamp    all < text

that holds all its values; a column whose values need a wider type than some of them is
reported as mixed, with its counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLASSES = ("boolean", "long", "double", "date", "timestamp", "text")

BOOLEAN = r"^(?i:true|false)$"
LONG = r"^[+-]?[0-9]{1,18}$"
DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"

#: Columns whose classes are counted together.
BLOCK = 8

SPARK_TYPES = {
    "boolean": T.BooleanType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "text": T.StringType(),
}


def value_class(value: Column) -> Column:
    """The class of one value, blanks around it left out; null for null and blank values."""
    return F.get(F.array(F.lit(None).cast("string"), *map(F.lit, CLASSES)), class_number(value))


def class_number(value: Column) -> Column:
    """The class of one value as its place in ``CLASSES``, from 1; 0 for null and blank values."""
    v = F.trim(value)
    first, n = F.ascii(v), {c: F.lit(i) for i, c in enumerate(CLASSES, start=1)}
    # most text is told by its first character or length, without a pattern
    return (
        F.when(value.isNull() | (v == ""), F.lit(0))
        .when(first.isin(*map(ord, "tTfF")), F.when(v.rlike(BOOLEAN), n["boolean"]).otherwise(n["text"]))
        .when(~first.isin(*map(ord, "+-.0123456789")), n["text"])
        .when(v.rlike(LONG), n["long"])
        .when(v.rlike(DOUBLE), n["double"])
        # 10 or 19 characters, and perhaps a line end
        .when(F.length(v).between(10, 12) & v.rlike(DATE) & v.try_cast("date").isNotNull(), n["date"])
        .when((F.length(v) >= 19) & v.rlike(TIMESTAMP) & v.try_cast("timestamp").isNotNull(), n["timestamp"])
        .otherwise(n["text"])
    )


def _joined(counts: dict[str, Column]) -> Column:
    """The least type that holds all counted classes."""
    some = {c: n > 0 for c, n in counts.items()}
    flags, numbers, days = some["boolean"], some["long"] | some["double"], some["date"] | some["timestamp"]
    families = flags.cast("int") + numbers.cast("int") + days.cast("int")
    return (
        F.when(some["text"] | (families != 1), "text")
        .when(flags, "boolean")
        .when(numbers, F.when(some["double"], "double").otherwise("long"))
        .otherwise(F.when(some["timestamp"], "timestamp").otherwise("date"))
    )


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(position, column, type, mixed, n_missing, n_boolean ... n_text), one row per column.

    A column without any value is text.  Each value is classed once; a row goes into one count
    a block, so all columns are counted in one aggregation.
    """
    columns = list(columns or df.columns)
    # one expression for all values of a block; written out once a column it is too large to be compiled
    blocks = [
        F.struct(F.lit(i).alias("start"), F.transform(F.array(*[F.col(f"`{c}`").cast("string") for c in columns[i : i + BLOCK]]), class_number).alias("classes"))
        for i in range(0, len(columns), BLOCK)
    ]
    rows = df.select(F.explode(F.array(*blocks)).alias("b")).groupBy("b.start", "b.classes").agg(F.count(F.lit(1)).alias("n"))
    single = rows.select("start", F.posexplode("classes").alias("at", "number"), "n")
    kind = F.get(F.array(F.lit(None).cast("string"), *map(F.lit, CLASSES)), F.col("number"))
    counted = single.groupBy((F.col("start") + F.col("at")).alias("position"), kind.alias("kind")).agg(F.sum("n").alias("n"))
    every = df.sparkSession.range(len(columns)).select(F.col("id").cast("int").alias("position"), F.lit(None).cast("string").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    wide = counted.unionByName(every).groupBy("position").agg(
        F.sum(F.when(F.col("kind").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n_{k}") for k in CLASSES],
    )
    counts = {k: F.col(f"n_{k}") for k in CLASSES}
    kinds = sum(((n > 0).cast("int") for n in counts.values()), F.lit(0))
    name = F.get(F.array(*map(F.lit, columns)), F.col("position"))
    return wide.select("position", name.alias("column"), _joined(counts).alias("type"), (kinds > 1).alias("mixed"), "n_missing", *counts.values())


def inferred_schema(report: DataFrame) -> T.StructType:
    """The report as a schema (one row per column reaches the driver)."""
    rows = report.orderBy("position").collect()
    return T.StructType([T.StructField(r["column"], SPARK_TYPES[r["type"]], True) for r in rows])


def as_inferred(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The all-string frame cast to ``schema``; values that don't fit are null in any ANSI mode."""
    return df.select(*[F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) if not isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in schema])


def read_typed_csv(spark: SparkSession, path: str, *, escape: str = '"', multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(typed frame, report) of delimited text whose columns and types are not known.

    Names come from the header line alone; the types from one pass over the values.
    """
    options = {"header": True, "escape": escape, "multiLine": multiline, "inferSchema": False}
    text = spark.read.options(**options).csv(path)
    report = infer_types(text)
    return as_inferred(text, inferred_schema(report)), report
