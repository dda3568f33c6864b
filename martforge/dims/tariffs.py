"""Tariff dimension for the conclusions summary.

Two versions of the procedure-code dimension are valid on either side of a
boundary date. The code -> (service type, zones) part grows with the data and
is built from the procedure table by a rule; the service type -> coefficient
part is a fixed, bounded table (broadcast).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOUNDARY = dt.date(2026, 6, 1)
FAR_PAST = dt.date(1900, 1, 1)
FAR_FUTURE = dt.date(2999, 12, 31)

# Coefficient per service type, old version (before the boundary).
OLD_COEFS = [
    ("КТ с КУ 1 зона", "30.41"),
    ("КТ с КУ 2 и более зон", "49.75"),
    ("КТ 1 зона", "11.58"),
    ("КТ 2 и более зон", "11.58"),
    ("МРТ 1 зона", "15.06"),
    ("МРТ 2 и более зон", "15.06"),
    ("МРТ с КУ 1 зона", "34.71"),
    ("МРТ с КУ 2 и более зон", "60.25"),
    ("ММГ", "3.67"),
    ("РГ", "3.67"),
    ("ФЛГ", "1.0"),
    ("Денс", "2.15"),
]

# Coefficient per service type, new version (from the boundary on).
NEW_COEFS = [
    ("КТ с КУ 1 зона", "35.71"),
    ("КТ с КУ 2 зоны", "43.01"),
    ("КТ с КУ 3 зоны", "50.30"),
    ("КТ 1 зона", "14.59"),
    ("КТ 2 зоны", "21.88"),
    ("КТ 3 зоны", "29.17"),
    ("КТ 4 зоны", "36.47"),
    ("МРТ 1 зона", "17.22"),
    ("МРТ 2 зоны", "25.86"),
    ("МРТ 3 зоны", "34.44"),
    ("МРТ с КУ 1 зона", "39.92"),
    ("МРТ с КУ 2 зоны", "48.50"),
    ("МРТ с КУ 3 зоны", "57.14"),
    ("ММГ", "3.67"),
    ("РГ", "3.67"),
    ("ФЛГ", "1.0"),
    ("Денс", "2.15"),
]

# Coefficient for unknown service types, and the low coefficient
# that applies to the listed codes when the AI found the study normal.
DEFAULT_COEF = "1.0"
AI_NORMAL_COEF = "0.3"
AI_NORMAL_CODES = (33, 34, 427)

# Families that are priced by zones.
ZONED = ("КТ", "КТ с КУ", "МРТ", "МРТ с КУ")


def coefficient_table(spark: SparkSession, boundary: dt.date = BOUNDARY) -> DataFrame:
    """(service_type, coef, valid_from, valid_to): bounded, 29 rows."""
    rows = [(s, c, FAR_PAST, boundary) for s, c in OLD_COEFS] + \
           [(s, c, boundary, FAR_FUTURE) for s, c in NEW_COEFS]
    return (spark.createDataFrame(rows, "service_type string, coef string, valid_from date, valid_to date")
            .withColumn("coef", F.col("coef").cast("decimal(18,2)")))


def _zones_label(n: F.Column) -> F.Column:
    return F.when(n == 1, F.lit(" 1 зона")).otherwise(F.concat(F.lit(" "), n.cast("string"), F.lit(" зоны")))


def code_dimension(codes: DataFrame, family_col: str = "family", zones_col: str = "zones",
                   code_col: str = "diagnostic_code", boundary: dt.date = BOUNDARY) -> DataFrame:
    """Rule-built two-version code dimension.

    Zone families (КТ, МРТ, with or without contrast) get '1 зона' / '2 и более
    зон' in the old version and the exact zone count in the new version; other families are their own service type.
    """
    fam, z = F.col(family_col), F.col(zones_col)
    zoned = fam.isin(list(ZONED))
    old = F.when(zoned, F.concat(fam, F.when(z == 1, F.lit(" 1 зона")).otherwise(F.lit(" 2 и более зон")))) \
        .otherwise(fam)
    new = F.when(zoned, F.concat(fam, _zones_label(z))).otherwise(fam)
    base = codes.select(F.col(code_col).alias("diagnostic_code"), old.alias("old_type"), new.alias("new_type"),
                        z.alias("z"))
    old_v = base.select("diagnostic_code", F.col("old_type").alias("service_type"),
                        F.col("z").alias("anatomical_areas"),
                        F.lit(FAR_PAST).alias("valid_from"), F.lit(boundary).alias("valid_to"))
    new_v = base.select("diagnostic_code", F.col("new_type").alias("service_type"),
                        F.col("z").alias("anatomical_areas"),
                        F.lit(boundary).alias("valid_from"), F.lit(FAR_FUTURE).alias("valid_to"))
    return old_v.unionByName(new_v)
