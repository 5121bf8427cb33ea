"""Scans, sinks, unions and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.catalog.registry import query
from ledgerlift.catalog.views import VIEW_SQL, Views, with_views
from ledgerlift.functions import normalize as N
from ledgerlift.session import staging_path
from ledgerlift.sources import sinks, tables

ADV_SCHEMA = "request_id BIGINT, user_id BIGINT, underwritten_at TIMESTAMP_NTZ, requested_amount DOUBLE"


@query(
    "union_transactions",
    with_views(
        "tx",
        """SELECT id, user_id, date, amount, merchant_name, primary_category,
           CASE WHEN amount >= 0 THEN detailed_category END AS detailed_category FROM tx""",
    ),
)
def union_transactions(v: Views):
    spark = v.spark
    tx, base = v.tx(), staging_path(v.spark, "union")
    tx.where(F.col("amount") < 0).drop("detailed_category").write.parquet(f"{base}/in")
    tx.where(F.col("amount") >= 0).write.parquet(f"{base}/out")
    return tables.union_existing(spark, [f"{base}/in", f"{base}/absent", f"{base}/out"])


@query(
    "union_mixed_types",
    """SELECT lower(hex('z' || o_custkey)) AS user_id, '1' AS id,
         CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 7 <> 1 THEN date_trunc('day', o_orderdate) END AS date,
         CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 5 <> 1 THEN o_totalprice ELSE 0 END AS amount
       FROM orders""",
)
def union_mixed_types(v: Views):
    """One file with binary ids, timestamps and doubles, one with literals, text dates and text amounts with junk."""
    spark, base = v.spark, staging_path(v.spark, "mixed")
    orders = v.table("orders")
    user, day = F.concat(F.lit("z"), F.col("o_custkey").cast("string")), F.date_trunc("day", "o_orderdate")
    orders.where("o_orderkey % 2 = 0").select(
        user.cast("binary").alias("user_id"),
        F.col("o_orderkey").alias("id"),
        day.cast("timestamp_ntz").alias("date"),
        F.col("o_totalprice").alias("amount"),
    ).write.parquet(f"{base}/bytes")
    escaped = F.regexp_replace(F.hex(user.cast("binary")), "(..)", r"\\x$1")
    orders.where("o_orderkey % 2 <> 0").select(
        F.concat(F.lit("b'"), escaped, F.lit("'")).alias("user_id"),
        F.concat(F.lit("t"), "o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 7 == 1, "junk").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(F.col("o_orderkey") % 5 == 1, "junk").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
    ).write.parquet(f"{base}/text")
    files = tables.read_existing(spark, [f"{base}/bytes", f"{base}/absent", f"{base}/text"])
    return tables.normalize_transaction_files([tables.presence_only(f, "id") for f in files])


@query("csv_round_trip", VIEW_SQL["adv"])
def csv_round_trip(v: Views):
    path = staging_path(v.spark, "csv")
    sinks.write_csv(v.adv(), path)
    return tables.read_csv(v.spark, path, ADV_SCHEMA)


@query("csv_inferred_types", VIEW_SQL["adv"])
def csv_inferred_types(v: Views):
    path = staging_path(v.spark, "csv")
    sinks.write_csv(v.adv(), path)
    return N.normalize_dates(tables.read_csv(v.spark, path), ("underwritten_at",)).withColumn(
        "underwritten_at", F.col("underwritten_at").cast("timestamp_ntz")
    ).select(*[F.col(c).cast(t) for c, t in (p.split() for p in ADV_SCHEMA.split(", "))])


@query("key_list_export", with_views("adv adv_labels fa", "SELECT user_id FROM fa JOIN adv_labels ON request_id = advance_id"))
def key_list_export(v: Views):
    from ledgerlift.operators.cohort import label_join

    path = staging_path(v.spark, "keys")
    sinks.write_keys(label_join(v.fa(), v.adv_labels()), "user_id", path)
    return tables.read_csv(v.spark, path, "user_id BIGINT")


@query(
    "indexed_series_sink",
    "SELECT p_name AS feature, round(avg(p_retailprice), 6) AS importance FROM part GROUP BY p_name",
)
def indexed_series_sink(v: Views):
    series = v.table("part").groupBy(F.col("p_name").alias("feature")).agg(
        F.round(F.avg("p_retailprice"), 6).alias("importance")
    )
    path = staging_path(v.spark, "series")
    sinks.write_series(series, "feature", "importance", path)
    return tables.read_csv(v.spark, path, "feature STRING, importance DOUBLE")


@query("materialized_read", VIEW_SQL["adv"])
def materialized_read(v: Views):
    path = staging_path(v.spark, "table")
    sinks.materialize(v.adv(), path)
    return sinks.materialize(v.adv(), path, refresh=False)


@query(
    "normalize_hex_ids",
    """SELECT lower(hex(CAST(o_orderkey AS VARCHAR))) AS request_id, lower(hex(o_orderpriority)) AS id,
       CAST(o_custkey AS VARCHAR) AS user_id FROM orders""",
)
def normalize_hex_ids(v: Views):
    raw = v.table("orders").select(
        F.encode(F.col("o_orderkey").cast("string"), "UTF-8").alias("request_id"),
        F.encode("o_orderpriority", "UTF-8").alias("id"),
        F.col("o_custkey").alias("user_id"),
    )
    return N.normalize_ids(raw, ("request_id", "id", "user_id", "advance_id"))


@query(
    "decode_byte_literals",
    """SELECT o_orderkey, lower(hex(o_orderpriority)) AS escaped,
       lower(hex(concat(o_orderpriority, chr(9), chr(39), chr(92), chr(0)))) AS named,
       concat('b"', o_orderpriority, '"') AS other FROM orders""",
)
def decode_byte_literals(v: Views):
    pairs = F.regexp_replace(F.hex("o_orderpriority"), "(..)", r"\\x$1")
    raw = v.table("orders").select(
        "o_orderkey",
        F.concat(F.lit("b'"), pairs, F.lit("'")).alias("escaped"),
        F.concat(F.lit("b'"), "o_orderpriority", F.lit("\\t\\'\\\\\\0'")).alias("named"),
        F.concat(F.lit('b"'), "o_orderpriority", F.lit('"')).alias("other"),
    )
    return N.normalize_ids(raw, ("escaped", "named", "other"))


@query("decode_text_bytes", "SELECT doc_id, text, text AS utf8 FROM documents")
def decode_text_bytes(v: Views):
    raw = v.table("documents").select(
        "doc_id",
        F.when(F.col("text").rlike(r"^[\u0000-ÿ]*$"), F.encode("text", "ISO-8859-1"))
        .otherwise(F.encode("text", "UTF-8"))
        .alias("text"),
        F.encode("text", "UTF-8").alias("utf8"),
    )
    return N.normalize_text(raw, ("text", "utf8", "missing"))


@query(
    "parse_dates_amounts",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS date,
       CASE WHEN event_type = 'error' THEN 0 ELSE value END AS amount,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""",
)
def parse_dates_amounts(v: Views):
    junk = F.col("event_type") == "error"
    raw = v.table("events").select(
        "event_id",
        F.when(junk, F.concat(F.col("ts").cast("string"), F.lit(" junk"))).otherwise(F.col("ts").cast("string")).alias("date"),
        F.when(junk, F.concat(F.col("value").cast("string"), F.lit("d"))).otherwise(F.col("value").cast("string")).alias("amount"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    parsed = N.normalize_dates(raw, ("date",))
    return parsed.withColumns({c: N.amount(F.col(c), parsed.schema[c].dataType) for c in ("amount", "k")})


@query("numeric_cast_or_keep", "SELECT event_id, user_id, value, event_type FROM events")
def numeric_cast_or_keep(v: Views):
    raw = v.table("events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").cast("string").alias("value"),
        "event_type",
    )
    return N.numeric_or_keep(raw, ("user_id", "value", "event_type", "missing"))


@query(
    "numeric_matrix",
    """SELECT event_id, CAST(user_id AS DOUBLE) AS user_id,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN 0 ELSE value END AS value,
       CAST(value AS DOUBLE) AS text_value FROM events""",
)
def numeric_matrix(v: Views):
    from ledgerlift.operators.supervised import numeric_matrix as matrix

    kind = F.col("event_type")
    raw = v.table("events").select(
        "event_id",
        "user_id",
        F.when(kind == "error", float("inf"))
        .when(kind == "view", float("nan"))
        .when(kind != "click", F.col("value"))
        .alias("value"),
        F.col("value").cast("string").alias("text_value"),
        "event_type",
        (kind == "view").alias("is_view"),
    )
    return matrix(raw, keep=("event_id",))
