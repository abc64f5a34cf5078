"""The UDF surface.

Built-in Column rules (``tidewater.functions.columns``) are the default path.
Where a caller needs a function callable from SQL text, it is registered as
a pandas (Arrow-batched) UDF, never a row-at-a-time Python UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The exam pass rule -- the one subject that needs an A, then
# the grade prefixes that pass it and that pass every other subject.
STRICT_SUBJECT = "Biology"
STRICT_GRADES = ("A",)
PASS_GRADES = ("A", "B", "C")

# The country grouping of the free-trial job.  Codes kept as
# they are, then the codes folded into EUROPE; everything else is OTHER.
TOP_COUNTRIES = ("GB", "US", "IN", "UNKNOWN")
EUROPEAN_COUNTRIES = ("BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "ES", "FR", "HR", "IT",
                      "CY", "LV", "LT", "LU", "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI",
                      "SK", "FI", "SE", "CH", "IS", "NO", "LI", "EU")


@F.pandas_udf(T.IntegerType())
def brand_number_udf(brand: pd.Series) -> pd.Series:
    """'Brand#13' -> 13 (vectorised)."""
    return brand.str.split("#", n=1).str[1].astype("Int32")


@F.pandas_udf(T.BooleanType())
def has_passed_udf(grade: pd.Series, subject: pd.Series) -> pd.Series:
    """Pass rule of the exam job (see the fixed values above)."""
    strict = grade.str.startswith(STRICT_GRADES)
    wide = grade.str.startswith(PASS_GRADES)
    return strict.where(subject == STRICT_SUBJECT, wide)


@F.pandas_udf(T.StringType())
def country_grouping_udf(country: pd.Series) -> pd.Series:
    out = pd.Series("OTHER", index=country.index, dtype=object)
    out[country.isin(EUROPEAN_COUNTRIES)] = "EUROPE"
    keep = country.isin(TOP_COUNTRIES)
    out[keep] = country[keep]
    return out


def register_brand_number(spark: SparkSession, name: str = "brand_number"):
    return spark.udf.register(name, brand_number_udf)


def register_has_passed(spark: SparkSession, name: str = "hasPassed"):
    return spark.udf.register(name, has_passed_udf)


def register_country_grouping(spark: SparkSession, name: str = "countryGrouping"):
    return spark.udf.register(name, country_grouping_udf)
