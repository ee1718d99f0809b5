"""People queries with the DataFrame API and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def names(people: DataFrame) -> DataFrame:
    """P27."""
    return people.select("name")


def under_age(people: DataFrame, age: int = 21) -> DataFrame:
    """Rows with age below ``age``."""
    return people.filter(F.col("age") < age)


def count_by_age(people: DataFrame) -> DataFrame:
    """P29."""
    return people.groupBy("age").agg(F.count(F.lit(1)).alias("n"))


def age_plus(people: DataFrame, years: int = 10) -> DataFrame:
    """P30."""
    return people.select("name", (F.col("age") + years).alias(f"age_plus_{years}"))


def teens_sql(people: DataFrame, low: int = 13, high: int = 19) -> DataFrame:
    """The same filter written in SQL. The table is passed to the statement by name, so
    no view of the caller is replaced."""
    return people.sparkSession.sql("SELECT * FROM {people} WHERE age >= {low} AND age <= {high}",
                                   people=people, low=int(low), high=int(high))
