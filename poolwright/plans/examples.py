"""Two small jobs: clients with their contracts, and group sizes by period."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolwright.functions.exprs import row_hash


def vip_clients(clients: DataFrame, youngest: int = 30, oldest: int = 50) -> DataFrame:
    return clients.filter(F.col("age").between(youngest, oldest) & (F.col("vip") == "true"))


def contracts_of_clients(clients: DataFrame, contracts: DataFrame, products: DataFrame) -> DataFrame:
    """Contracts with their holder and product; Spark broadcasts products of a small known size."""
    held = contracts.join(clients, contracts["holder_id"] == clients["client_id"]).drop("holder_id")
    return held.join(products, "product_id").select(
        "contract_id", "product_id", "opened", "product_name", *clients.columns)


def busy_clients(joined: DataFrame, more_than: int = 3) -> DataFrame:
    """Rows of clients with more than ``more_than`` contracts, as SQL text over a view."""
    view = f"client_contract_rows_{uuid.uuid4().hex}"  # two jobs of one session keep apart
    joined.createOrReplaceTempView(view)
    return joined.sparkSession.sql(
        f"SELECT * FROM {view} WHERE client_id IN (SELECT client_id FROM {view} GROUP BY client_id HAVING count(*) > :n)",
        args={"n": more_than})


def clients_contracts(clients: DataFrame, contracts: DataFrame, products: DataFrame,
                      output: str | None = None) -> DataFrame:
    joined = contracts_of_clients(vip_clients(clients), contracts, products)
    busy = busy_clients(joined)
    hashed = busy.withColumn("hash", row_hash(busy.columns))
    if output:
        hashed.write.mode("overwrite").parquet(output)
    return hashed


def clean_with_date_parts(people: DataFrame) -> DataFrame:
    """Rows without any NULL, with the date parsed and taken apart."""
    dated = people.na.drop().withColumn("date", F.to_date("date"))
    return dated.withColumns({"day": F.dayofmonth("date"), "month": F.month("date"), "year": F.year("date")})


def size_by_period(people: DataFrame, min_age: int, by_city: bool) -> DataFrame:
    keys = ["year", "city"] if by_city else ["year"]
    kept = clean_with_date_parts(people).filter(F.col("age") > min_age)
    return kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
