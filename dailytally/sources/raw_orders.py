"""Orders as text lines (JSON lines or CSV), read so that a malformed line is a reject, not a failed run.

Each line is parsed permissively: fields that can be read are kept, and ``raw_line`` holds the
whole line where any of them could not (null otherwise). Such a row has the reject reason
``unparsed`` (``operators/quality.py``) whatever else is wrong with it. Lines are parsed after the
scan and with all fields, so which columns a query reads never decides whether a line is malformed.

CSV: fields in contract order; a line equal to the header (the column names, comma-separated) is
no order. Lines of white space are no orders. A record is one line in either format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailytally.config import ORDER_COLS
from dailytally.operators.quality import RAW_COL
from dailytally.schemas import ORDERS

TEXT_FORMATS = ("json", "csv")
_PARSED = T.StructType([*[T.StructField(f.name, f.dataType) for f in ORDERS.fields], T.StructField(RAW_COL, T.StringType())])


def parse_orders(lines: DataFrame, fmt: str) -> DataFrame:
    """Rows of the contract columns and ``raw_line`` from one string column of lines."""
    if fmt not in TEXT_FORMATS:
        raise ValueError(f"unknown text format {fmt!r}")
    line = F.col(lines.columns[0])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_COL}
    kept = lines.where(line.rlike(r"\S"))
    if fmt == "csv":
        kept = kept.where(F.trim(line) != F.lit(",".join(ORDER_COLS)))
        parsed = F.from_csv(line, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in _PARSED.fields), options)
    else:
        parsed = F.from_json(line, _PARSED, options)
    rows = kept.select(line.alias("_line"), parsed.alias("_o"))
    return rows.select(*[F.col(f"_o.{c}").alias(c) for c in ORDER_COLS],
                       F.when(F.col(f"_o.{RAW_COL}").isNotNull(), F.col("_line")).alias(RAW_COL))


def read_raw_orders(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """S1/F6 on text files."""
    return parse_orders(spark.read.text(path), fmt)


__all__ = ["RAW_COL", "TEXT_FORMATS", "parse_orders", "read_raw_orders"]
