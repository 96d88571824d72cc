"""Lexicon tables ``(token string, valence decimal(4,2))``.

The reference calls an external scorer whose lexicon is not part of it; here the lexicon
is user input: a table (CSV/Parquet) or a literal list. The default list below is the
fixture used against the driver's invented prose (its ordinary sentiment words never occur).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LEXICON_SCHEMA = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("valence", T.DecimalType(4, 2), False),
])

# The fixture lexicon for the driver data (token, valence).
FIXTURE_LEXICON = (
    ("thth", "-1.5"), ("ou", "1.0"), ("er", "-0.5"), ("ing", "1.9"), ("tion", "-1.3"),
    ("que", "0.6"), ("und", "-0.4"), ("los", "1.2"), ("der", "-0.3"), ("une", "0.9"),
)


def lexicon_from_pairs(spark: SparkSession, pairs=FIXTURE_LEXICON) -> DataFrame:
    from decimal import Decimal
    return spark.createDataFrame([(t, Decimal(v)) for t, v in pairs], LEXICON_SCHEMA)


def read_lexicon(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A lexicon file with an explicit schema (never inferred)."""
    reader = spark.read.schema(LEXICON_SCHEMA)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def fixture_values_sql(pairs=FIXTURE_LEXICON) -> str:
    """The same lexicon as a DuckDB VALUES list (for the oracle)."""
    rows = ", ".join(f"('{t}', CAST({v} AS DECIMAL(4,2)))" for t, v in pairs)
    return f"(VALUES {rows}) AS lex(token, valence)"
