"""Canonical inputs of the operators, derived from the driver's parquet test tables.

Each ``*_df`` builder returns the canonical DataFrame; ``CTE`` holds the same
derivation in DuckDB SQL so oracle queries can be composed from identical inputs.

| canonical                       | from                                                        |
| ratings(user,item,rating,ts)    | events: user_id, props.k, value, ts                         |
| ratings_unique                  | latest ts per (user,item), tie -> largest event_id         |
| purchases(item_id, rating)      | lineitem: l_partkey, l_quantity                             |
| items(item_id, name, tags)      | part: p_partkey, p_name, tags = words of p_name             |
| people(id,name,age,num_friends) | part: p_partkey, p_brand, p_size, floor(p_retailprice)      |
| readings(station,type,value)    | events: user_id, event_type (purchase = TMIN, view = TMAX)  |
| spend(customer, amount)         | orders: o_custkey, o_totalprice                             |
| lines(line)                     | documents.text split into lines                             |
| incidence(node, grp)            | distinct (l_partkey, l_orderkey)                            |
| node_names(node, name)          | part: p_partkey, p_name                                     |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.functions import latest_per_key, spread, text_lines

TAG_SEPARATOR = " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.select(
        "event_id", "user_id",
        F.get_json_object("props", "$.k").try_cast("int").alias("item_id"),
        F.col("value").alias("rating"), "ts")
        .filter(F.col("item_id").isNotNull()))


def ratings_unique_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rating per (user, item); ties on ts go to the larger event_id."""
    return latest_per_key(ratings_df(spark, sf_dir), ["user_id", "item_id"], ["rating", "ts"])


def purchases_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("item_id"), F.col("l_quantity").alias("rating"))


def items_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
                    F.col("p_name").alias("tags"))


def people_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").cast("int").alias("id"), F.col("p_brand").alias("name"),
                    F.col("p_size").cast("int").alias("age"),
                    F.floor("p_retailprice").cast("int").alias("num_friends"))


def readings_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the reading type is the raw event type ("purchase" plays TMIN, "view" plays TMAX),
    # so a filter on it reaches the parquet scan
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("string").alias("station"), F.col("event_type").alias("type"),
                     F.col("value").alias("value"))


def spend_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("customer"), F.col("o_totalprice").alias("amount"))


def lines_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("text"))
    return d.select(F.explode(text_lines("text")).alias("line"))


def incidence_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("node"), F.col("l_orderkey").alias("grp")).distinct()


def node_names_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("node"), F.col("p_name").alias("name"))


# DuckDB derivations of the same canonical inputs, composed by ``with_ctes``.
CTE = {
    "ratings": """SELECT event_id, user_id,
        TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
        value AS rating, ts FROM events
        WHERE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NOT NULL""",
    "ratings_unique": """SELECT user_id, item_id, rating, ts, event_id FROM ratings
        QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC, event_id DESC) = 1""",
    "purchases": "SELECT l_partkey AS item_id, l_quantity AS rating FROM lineitem",
    "items": "SELECT p_partkey AS item_id, p_name AS name, p_name AS tags FROM part",
    "people": """SELECT CAST(p_partkey AS INTEGER) AS id, p_brand AS name,
        CAST(p_size AS INTEGER) AS age, CAST(floor(p_retailprice) AS INTEGER) AS num_friends FROM part""",
    "readings": "SELECT CAST(user_id AS VARCHAR) AS station, event_type AS type, value FROM events",
    "spend": "SELECT o_custkey AS customer, o_totalprice AS amount FROM orders",
    "lines": r"""SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
        ELSE regexp_split_to_array(regexp_replace(text, '(?:\r\n|\r|\n)$', ''), '\r\n|\r|\n') END) AS line
        FROM documents""",
    "incidence": "SELECT DISTINCT l_partkey AS node, l_orderkey AS grp FROM lineitem",
    "node_names": "SELECT p_partkey AS node, p_name AS name FROM part",
    # brute-force adjacency entries: one per (node, other node, shared group)
    "entries": "SELECT a.node AS src, b.node AS dst FROM incidence a JOIN incidence b ON a.grp = b.grp AND a.node <> b.node",
}

CTE_DEPS = {"ratings_unique": ["ratings"], "entries": ["incidence"]}


def with_ctes(names: list[str], body: str, extra: list[tuple[str, str]] | None = None,
              recursive: bool = False) -> str:
    """Prefix ``body`` with the canonical CTEs it needs (dependencies first)."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for dep in CTE_DEPS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({CTE[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in (extra or [])]
    head = "WITH RECURSIVE " if recursive else "WITH "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body
