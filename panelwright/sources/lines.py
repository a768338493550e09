"""Delimited text held in a column of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.frames import must_hold
from panelwright.functions.scalars import quoted
from panelwright.specs import END_OF_FILE


def ddl_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "line", separator: str = "|", marker: str = END_OF_FILE) -> DataFrame:
    """The fields of each line with declared types; a field that does not parse fails the job.

    So does a line with more or fewer fields than the schema, or an unclosed quote. Only a line that starts with ``marker``
    may be short; it gives nulls for the missing fields.
    """
    # with quoted parts out of the way, what separators are left part the fields; most lines have none, and a search is cheap
    parted = F.regexp_replace(quoted(column), '"(?:[^"]|"")*"', "")
    bare = F.when(F.contains(quoted(column), F.lit('"')), parted).otherwise(quoted(column))
    width = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + len(separator)
    whole = (width == len(separator) * len(schema.fields)) & ~F.contains(bare, F.lit('"'))
    whole = whole | F.startswith(quoted(column), F.lit(marker)) | quoted(column).isNull()
    lines = lines.where(must_hold(whole, "a line with missing fields, extra fields or an unclosed quote", F.lit(True)))
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    fields = F.from_csv(quoted(column), F.lit(ddl_of(text)), {"sep": separator}).alias("__f")
    return lines.select(fields).select(
        [F.col("__f")[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    )
