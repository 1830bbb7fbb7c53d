"""Rows of one table out of the INSERT statements of a SQL dump, with column expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quayside.sources.ranges import RANGE, records

# the dump's grammar as patterns; possessive, so long texts cost no stack and no second try
QUOTED = r"'[^'\\]*+(?:(?:\\.|'')[^'\\]*+)*+'"
NESTED = r"\([^()]*+\)"  # a function call as a value
ROW = rf"(?s)\((?:[^'()]++|{QUOTED}|{NESTED})*+\)"
VALUE = rf"(?s)[(,]\s*+((?:[^',()]++|{QUOTED}|{NESTED})*+)"
ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0"}  # any other escaped character stands for itself


def _unquoted(body: Column) -> Column:
    """The text of a quoted literal: doubled quotes, then escapes; escaped backslashes keep the rest apart."""
    def plain(part: Column) -> Column:
        for mark, character in ESCAPES.items():
            part = F.replace(part, F.lit("\\" + mark), F.lit(character))
        return F.regexp_replace(part, r"(?s)\\(.)", "$1")

    return F.array_join(F.transform(F.split(F.replace(body, F.lit("''"), F.lit("'")), r"\\\\"), plain), "\\")


def _value(text: Column) -> Column:
    text = F.trim(text)
    return F.when(F.upper(text) == "NULL", None).when(
        text.startswith("'") & text.endswith("'"), _unquoted(F.substring(text, F.lit(2), F.length(text) - 2))).otherwise(text)


def read_sql_dump(spark: SparkSession, path: str, table: str, schema: StructType | str, range_bytes: int = RANGE) -> DataFrame:
    """Rows of INSERT INTO `table` VALUES (...)[, (...)]; typed by `schema`, unreadable values NULL.

    Statements end in a semicolon at the end of a line, outside of quotes; many
    tasks read the dump (see `ranges`). A backslash or a doubled quote escapes
    inside quotes, and the word NULL outside of them is no value.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    head = f"(?is)^\\s*INSERT INTO `{re.escape(table)}` VALUES\\s*"
    statements = records(spark, path, "sql", range_bytes).filter(F.col("record").rlike(head + "\\("))
    rows = statements.select(F.explode(F.regexp_extract_all(F.regexp_replace("record", head, ""), F.lit(ROW), F.lit(0))).alias("r"))
    # without its closing bracket a row is bracket, value, comma, value ...
    values = rows.select(F.regexp_extract_all(F.expr("left(r, length(r) - 1)"), F.lit(VALUE), F.lit(1)).alias("v"))
    return values.select(*[_value(F.get("v", F.lit(i))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])
