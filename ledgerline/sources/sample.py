"""Sample customer table (the smoke-test input of the generic profile job).

The original generator builds rows 1..100 from fixed formulas. Here the
formulas are applied to any id column, so the sample scales with the table
that supplies the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the sample generator.
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"]
CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Sports"]
NAME_PREFIX = "Customer_"
FIRST_DATE = "2024-01-01"


def sample_customers(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows ``id, name, age, city, purchase_amount, purchase_date, category,
    score`` computed from ``ids[id_col]`` (1-based), as strings/ints/doubles
    like the original CSV."""
    i = F.col(id_col).cast("bigint")
    k = i - F.lit(1)

    def cycle(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]),
                            (F.pmod(k, F.lit(len(values))) + 1).cast("int"))

    return ids.select(
        i.alias("id"),
        F.concat(F.lit(NAME_PREFIX), i.cast("string")).alias("name"),
        (F.lit(20) + F.pmod(k, F.lit(50))).cast("int").alias("age"),
        cycle(CITIES).alias("city"),
        (F.lit(100.0) + k.cast("double") * F.lit(10.5)).alias("purchase_amount"),
        F.date_format(F.date_add(F.lit(FIRST_DATE).cast("date"), k.cast("int")),
                      "yyyy-MM-dd").alias("purchase_date"),
        cycle(CATEGORIES).alias("category"),
        (F.lit(70) + F.pmod(k, F.lit(30))).cast("int").alias("score"),
    )


def sample_customer_range(spark: SparkSession, n: int = 100) -> DataFrame:
    """The original fixed-size sample: ids ``1..n`` from ``spark.range``."""
    return sample_customers(spark.range(1, n + 1).withColumnRenamed("id", "id"))
