"""COPY text: one line per row, tabs between fields, backslash escapes, ``\\N`` for null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values of the format.
NULL = "\\N"
END = "\\."
ESCAPES = {"\t": "\\t", "\n": "\\n", "\r": "\\r", "\b": "\\b", "\f": "\\f", "\v": "\\v"}


def escaped(value: Column) -> Column:
    out = F.replace(value.cast("string"), F.lit("\\"), F.lit("\\\\"))
    for char, code in ESCAPES.items():
        out = F.replace(out, F.lit(char), F.lit(code))
    return F.coalesce(out, F.lit(NULL))


def unescaped(field: Column) -> Column:
    """The text of a field. Between escaped backslashes every other escape stands alone."""

    def plain(piece: Column) -> Column:
        for char, code in ESCAPES.items():
            piece = F.replace(piece, F.lit(code), F.lit(char))
        return piece

    pieces = F.transform(F.split(field, r"\\\\", -1), plain)
    return F.when(field != NULL, F.array_join(pieces, "\\"))


def write(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws("\t", *[escaped(F.col(c)) for c in df.columns]).alias("line")).write.text(path)


def read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    fields = F.split("value", "\t", -1)
    lines = spark.read.text(path).where(F.col("value") != END)
    return lines.select(*[unescaped(F.get(fields, F.lit(i))).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])
