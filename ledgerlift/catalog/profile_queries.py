"""Table profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.catalog.registry import query
from ledgerlift.catalog.views import Views, with_views
from ledgerlift.operators import profile, split
from ledgerlift.plans import profiling

TX_COLUMNS = ("id", "user_id", "date", "amount", "merchant_name", "primary_category", "detailed_category")
NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _per_column(columns, expression: str, source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {expression.format(c=c)} FROM {source}" for c in columns)


@query(
    "null_fraction",
    with_views("tx", _per_column(TX_COLUMNS, "avg(CAST({c} IS NULL AS INTEGER)) AS null_fraction", "tx")),
)
def null_fraction(v: Views):
    return profile.null_fraction(v.tx())


@query(
    "shape",
    with_views("tx", "SELECT count(*) AS n_rows, 7 AS n_columns, count(*) * 7 AS n_cells FROM tx"),
)
def shape(v: Views):
    return profile.shape(v.tx())


TX_TYPES = ("bigint", "bigint", "timestamp_ntz", "double", "string", "string", "string")


@query(
    "schema_listing",
    with_views(
        "tx",
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS type, avg(CAST({c} IS NULL AS INTEGER)) AS null_fraction FROM tx"
            for i, (c, t) in enumerate(zip(TX_COLUMNS, TX_TYPES))
        ),
    ),
)
def schema_listing(v: Views):
    """Columns and types, with how much of each is missing."""
    tx = v.tx()
    return profile.schema_listing(tx).join(profile.null_fraction(tx), "column_name")


@query(
    "distinct_counts",
    with_views("tx", _per_column(TX_COLUMNS, "count(DISTINCT {c}) AS distinct_values", "tx")),
)
def distinct_counts(v: Views):
    return profile.distinct_counts(v.tx())


@query(
    "approximate_distinct_within",
    with_views("tx", "SELECT unnest(['id', 'user_id', 'date', 'amount', 'merchant_name', 'primary_category', 'detailed_category']) AS column_name, true AS within"),
)
def approximate_distinct_within(v: Views):
    """The approximate counts are within 15 % of the exact ones."""
    exact = profile.distinct_counts(v.tx()).withColumnRenamed("distinct_values", "exact")
    both = profile.distinct_counts(v.tx(), approximate=True).join(exact, "column_name")
    return both.select("column_name", (F.abs(F.col("distinct_values") - F.col("exact")) <= 0.15 * F.col("exact")).alias("within"))


@query("approximate_distinct_counts")
def approximate_distinct_counts(v: Views):
    return profile.distinct_counts(v.tx(), approximate=True)


@query(
    "describe",
    _per_column(
        NUMBERS,
        """count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min,
           round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
           round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max""",
        "lineitem",
    ),
)
def describe(v: Views):
    report = profile.describe(v.table("lineitem"), list(NUMBERS))
    return report.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p25", "p50", "p75")})


@query(
    "histogram",
    """WITH w AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS width FROM lineitem),
       c AS (SELECT least(floor((l_extendedprice - lo) / width), 19) AS place, count(*) AS found FROM lineitem, w GROUP BY place),
       b AS (SELECT CAST(bucket AS INTEGER) AS bucket, lo, width FROM range(20) r(bucket), w)
       SELECT bucket, lo + bucket * width AS low, lo + bucket * width + width AS high, coalesce(found, 0) AS n
       FROM b LEFT JOIN c ON bucket = place""",
)
def histogram(v: Views):
    return profile.histogram(v.table("lineitem"), "l_extendedprice", 20)


@query(
    "outliers",
    """SELECT l_orderkey, l_linenumber, price, price < lo - 1.5 * (hi - lo) OR price > hi + 1.5 * (hi - lo) AS is_outlier
       FROM (SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS price FROM lineitem),
            (SELECT quantile_cont(l_extendedprice * l_quantity, 0.25) AS lo,
                    quantile_cont(l_extendedprice * l_quantity, 0.75) AS hi FROM lineitem)""",
)
def outliers(v: Views):
    price = F.col("l_extendedprice") * F.col("l_quantity")
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber", price.alias("price"))
    return profile.outliers(rows, "price")


_PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1 :]]


@query(
    "correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS
    ),
)
def correlations(v: Views):
    return profile.correlations(v.table("lineitem"), list(NUMBERS)).withColumn("r", F.round("r", 6))


@query(
    "target_balance",
    with_views(
        "scored",
        "SELECT fold, y, count(*) AS n FROM (SELECT y, CAST((row_number() OVER "
        "(ORDER BY y, md5(concat(id, '|', '42')), id) - 1) % 5 AS INTEGER) AS fold FROM scored) GROUP BY ALL",
    ),
)
def target_balance(v: Views):
    return profile.target_balance(split.stratified_folds(v.scored()), "y", ("fold",))


@query(
    "sparsity",
    _per_column(NUMBERS, "avg(CAST({c} IS NULL OR {c} = 0 AS INTEGER)) AS sparsity", "lineitem"),
)
def sparsity(v: Views):
    return profile.sparsity(v.table("lineitem"), list(NUMBERS))


_TABLES = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}


def _with_users(v: Views):
    """Three of the given tables with their user key under one name."""
    return {name: v.table(name).withColumnRenamed(key, "user_id") for name, key in _TABLES.items()}


@query(
    "table_shapes",
    """SELECT 'customer' AS table_name, count(*) AS n_rows, 5 AS n_columns, count(*) * 5 AS n_cells FROM customer
       UNION ALL SELECT 'orders', count(*), 6, count(*) * 6 FROM orders
       UNION ALL SELECT 'events', count(*), 6, count(*) * 6 FROM events""",
)
def table_shapes(v: Views):
    return profiling.table_shapes(_with_users(v))


@query(
    "key_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS distinct_values FROM {t}" for t, k in _TABLES.items()
    ),
)
def key_counts(v: Views):
    return profiling.key_counts(_with_users(v))
