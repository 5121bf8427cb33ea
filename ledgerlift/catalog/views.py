"""The given tables read as advances, labels, transactions and scores.

Orders stand for advances and lineitems for transactions. Every view covers its whole table; each
has a Spark form (a method of ``Views``) and a SQL form (an entry of ``VIEW_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_schemas: dict[str, T.StructType] = {}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        """A given table; its schema is inferred once and stated from then on."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def tx(self) -> DataFrame:
        """Lineitems as transactions: returned items are money coming in."""
        returned, open_ = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
        # What a lineitem has to say is made small before it moves.
        lines = self.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            F.col("l_shipdate").alias("date"),
            F.when(returned, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
            F.when(returned & open_, 1).when(returned, 2).when(F.col("l_quantity") != 50, 3).cast("tinyint").alias("kind"),
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        supplier = self.table("supplier").select("s_suppkey", "s_name")
        part = self.table("part").select("p_partkey", "p_type", "p_brand")
        rows = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        )
        kind = F.col("kind")
        return rows.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("o_custkey").alias("user_id"),
            "date",
            "amount",
            F.when(F.col("l_linenumber") != 3, F.col("s_name")).alias("merchant_name"),
            F.when(kind == 1, "TRANSFER_IN").when(kind == 2, "INCOME").when(kind == 3, F.col("p_type")).alias("primary_category"),
            F.col("p_brand").alias("detailed_category"),
        )

    def adv(self) -> DataFrame:
        """Orders as advances. Some have no underwriting date, some no requested amount."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("request_id"),
            F.col("o_custkey").alias("user_id"),
            F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderdate")).alias("underwritten_at"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("requested_amount"),
        )

    def adv_labels(self) -> DataFrame:
        """Finished and open orders as labels; pending ones have none."""
        return self.table("orders").where(F.col("o_orderstatus") != "P").select(
            F.col("o_orderkey").alias("advance_id"),
            (F.col("o_orderstatus") == "F").cast("int").alias("target"),
        )

    def fa(self) -> DataFrame:
        from ledgerlift.plans.features import first_advances

        return first_advances(self.adv())

    def scored(self) -> DataFrame:
        """Orders with a score that many of them share."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            (F.col("o_orderstatus") == "F").cast("int").alias("y"),
            (F.pmod(F.col("o_orderkey") * 7919, F.lit(1009)).cast("double") / F.lit(1009.0)).alias("p"),
        )

    def event_tx(self) -> DataFrame:
        """Events as transactions with times to the microsecond."""
        return self.table("events").select(
            F.col("event_id").alias("id"),
            "user_id",
            F.col("ts").alias("date"),
            F.col("value").alias("amount"),
            F.get_json_object("props", "$.k").alias("merchant_name"),
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("primary_category"),
            F.col("props").alias("detailed_category"),
        )

    def event_anchor(self) -> DataFrame:
        """Each user's last event as the anchor."""
        return self.table("events").groupBy("user_id").agg(F.max("ts").alias("underwritten_at"))


VIEW_SQL = {
    "tx": """
        SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS user_id, l_shipdate AS date,
               CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
               CASE WHEN l_linenumber <> 3 THEN s_name END AS merchant_name,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'TRANSFER_IN'
                    WHEN l_returnflag = 'R' THEN 'INCOME'
                    WHEN l_quantity <> 50 THEN p_type END AS primary_category,
               p_brand AS detailed_category
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN part ON l_partkey = p_partkey""",
    "adv": """
        SELECT o_orderkey AS request_id, o_custkey AS user_id,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS underwritten_at,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS requested_amount
        FROM orders""",
    "adv_labels": """
        SELECT o_orderkey AS advance_id, CAST(o_orderstatus = 'F' AS INTEGER) AS target
        FROM orders WHERE o_orderstatus <> 'P'""",
    "fa": """
        SELECT user_id,
               first(request_id ORDER BY underwritten_at NULLS LAST, request_id) AS request_id,
               first(underwritten_at ORDER BY underwritten_at NULLS LAST, request_id)
                   FILTER (WHERE underwritten_at IS NOT NULL) AS underwritten_at,
               first(requested_amount ORDER BY underwritten_at NULLS LAST, request_id)
                   FILTER (WHERE requested_amount IS NOT NULL) AS requested_amount
        FROM adv GROUP BY user_id""",
    "scored": """
        SELECT o_orderkey AS id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
               CAST((o_orderkey * 7919) % 1009 AS DOUBLE) / CAST(1009 AS DOUBLE) AS p
        FROM orders""",
    "event_tx": """
        SELECT event_id AS id, user_id, ts AS date, value AS amount,
               json_extract_string(props, '$.k') AS merchant_name,
               CASE WHEN event_type <> 'error' THEN event_type END AS primary_category,
               props AS detailed_category
        FROM events""",
    "event_anchor": "SELECT user_id, max(ts) AS underwritten_at FROM events GROUP BY user_id",
    "tx_before": """
        SELECT tx.*, fa.underwritten_at FROM tx JOIN fa ON tx.user_id = fa.user_id
        WHERE tx.date < fa.underwritten_at""",
    "outflow": """
        SELECT user_id, primary_category, CAST(amount AS DECIMAL(18, 2)) AS amount FROM tx
        WHERE primary_category IS NOT NULL AND primary_category NOT IN ('INCOME', 'TRANSFER_IN') AND amount > 0""",
}
NEEDS = {
    "fa": ("adv",),
    "tx_before": ("tx", "adv", "fa"),
    "outflow": ("tx",),
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the named views and whatever they need, as common table expressions."""
    ordered: list[str] = []
    for name in names.split():
        for needed in (*NEEDS.get(name, ()), name):
            if needed not in ordered:
                ordered.append(needed)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in ordered) + "\n" + body
