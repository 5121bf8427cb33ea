"""First advances, spending, flow, diversity and the supervised table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.catalog.registry import query
from ledgerlift.catalog.views import Views, with_views
from ledgerlift.functions.arithmetic import whole_days
from ledgerlift.operators import cohort, diversity, flow, spending, supervised
from ledgerlift.plans import features
from ledgerlift.plans.incremental import FeatureState
from ledgerlift.session import stage, staging_path

# The categories of the given tables, for writing pivots in SQL.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("first_advance_non_null", with_views("adv fa", "SELECT * FROM fa"))
def first_advance_non_null(v: Views):
    return cohort.first_per_key(v.adv(), "user_id", "underwritten_at", "request_id")


@query(
    "first_advance_row",
    with_views(
        "adv",
        """SELECT request_id, user_id, underwritten_at, requested_amount FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY underwritten_at NULLS LAST, request_id) AS n
           FROM adv) WHERE n = 1""",
    ),
)
def first_advance_row(v: Views):
    return cohort.first_per_key(v.adv(), "user_id", "underwritten_at", "request_id", "row")


@query(
    "label_join",
    with_views(
        "adv adv_labels fa",
        """SELECT user_id, request_id, underwritten_at, requested_amount, advance_id, target
           FROM fa JOIN adv_labels ON request_id = advance_id""",
    ),
)
def label_join(v: Views):
    return cohort.label_join(v.fa(), v.adv_labels())


@query(
    "key_overlap",
    with_views(
        "adv adv_labels fa",
        """SELECT count(*) AS shared_keys FROM (
           SELECT request_id FROM fa INTERSECT SELECT advance_id FROM adv_labels)""",
    ),
)
def key_overlap(v: Views):
    return cohort.key_overlap(v.fa(), "request_id", v.adv_labels(), "advance_id")


@query(
    "common_keys",
    with_views(
        "adv adv_labels fa",
        """SELECT CAST(request_id AS VARCHAR) AS key FROM fa
           INTERSECT SELECT CAST(advance_id AS VARCHAR) FROM adv_labels""",
    ),
)
def common_keys(v: Views):
    return cohort.common_keys(v.fa(), "request_id", v.adv_labels(), "advance_id")


@query(
    "semi_join_users",
    with_views("tx adv adv_labels fa", """SELECT tx.* FROM tx WHERE user_id IN (
        SELECT user_id FROM fa JOIN adv_labels ON request_id = advance_id)"""),
)
def semi_join_users(v: Views):
    return cohort.keep_known_users(v.tx(), cohort.label_join(v.fa(), v.adv_labels()))


@query(
    "categories_except",
    with_views("tx", """SELECT DISTINCT primary_category FROM tx WHERE primary_category IS NOT NULL
        EXCEPT SELECT unnest(['INCOME', 'TRANSFER_IN'])"""),
)
def categories_except(v: Views):
    return cohort.distinct_values(v.tx(), "primary_category", spending.INFLOW_CATEGORIES)


@query(
    "top_rows",
    with_views("tx", "SELECT * FROM tx ORDER BY user_id, date, id, amount LIMIT 20"),
)
def top_rows(v: Views):
    return cohort.top_rows(v.tx(), [F.col(c).asc() for c in ("user_id", "date", "id", "amount")], 20)


# --- spending -------------------------------------------------------------------------------


@query(
    "spending_sums",
    with_views("outflow", """SELECT user_id, primary_category, CAST(sum(amount) AS DOUBLE) AS amount
        FROM outflow GROUP BY ALL"""),
)
def spending_sums(v: Views):
    return spending.user_category_sums(v.tx())


_WIDE = ", ".join(
    f"CAST(coalesce(sum(amount) FILTER (WHERE primary_category = '{c}'), 0) AS DOUBLE) AS \"{c}\"" for c in CATEGORIES
)
_PIVOT = f"SELECT user_id, {_WIDE}, CAST(sum(amount) AS DOUBLE) AS total_spending FROM outflow GROUP BY user_id"
_SHARES = "SELECT user_id, " + ", ".join(
    f'"{c}" / CASE WHEN total_spending = 0 THEN 1 ELSE total_spending END AS "{c}"' for c in CATEGORIES
)


@query("spending_pivot", with_views("outflow", _PIVOT))
def spending_pivot(v: Views):
    tx = v.tx()
    return spending.spending_pivot(tx, spending.spending_categories(tx).names)


@query("spending_shares", with_views("outflow", f"{_SHARES}, total_spending FROM ({_PIVOT})"))
def spending_shares(v: Views):
    return spending.spending_shares(v.tx())


@query(
    "spending_shares_long",
    with_views("outflow", """SELECT user_id, primary_category, round(amount / CASE WHEN total = 0 THEN 1 ELSE total END, 9) AS share
        FROM (SELECT user_id, primary_category, CAST(sum(amount) AS DOUBLE) AS amount,
                     CAST(sum(sum(amount)) OVER (PARTITION BY user_id) AS DOUBLE) AS total
              FROM outflow GROUP BY user_id, primary_category)"""),
)
def spending_shares_long(v: Views):
    long = spending.spending_shares_long(v.tx())
    return long.withColumn("share", F.round("share", 9))


@query("spending_empty", "SELECT DISTINCT o_custkey AS user_id, CAST(0 AS DOUBLE) AS total_spending FROM orders")
def spending_empty(v: Views):
    all_in = v.tx().withColumn("amount", -F.abs("amount"))
    return spending.spending_shares(all_in, v.fa())


# --- flow -----------------------------------------------------------------------------------


def _inflow_sql(where: str) -> str:
    return f"""SELECT user_id, CAST(abs(sum(CAST(amount AS DECIMAL(18, 2)))) AS DOUBLE) AS total FROM tx
               WHERE amount < 0 AND {where} GROUP BY user_id"""


_FLOW = f"""
    SELECT user_id, total_outflow, total_inflow, total_income, total_transfer_in,
           total_outflow / CASE WHEN total_inflow = 0 THEN 1 ELSE total_inflow END AS outflow_inflow_ratio,
           least(greatest(total_outflow / CASE WHEN total_income = 0 THEN 1 ELSE total_income END, 0), 10)
               AS income_spent_pct
    FROM (
      SELECT user_id, coalesce(o.total, 0) AS total_outflow, coalesce(i.total, 0) AS total_inflow,
             coalesce(n.total, 0) AS total_income, coalesce(t.total, 0) AS total_transfer_in
      FROM (SELECT user_id, CAST(sum(amount) AS DOUBLE) AS total FROM outflow GROUP BY user_id) o
      FULL JOIN ({_inflow_sql("primary_category IN ('INCOME', 'TRANSFER_IN')")}) i USING (user_id)
      FULL JOIN ({_inflow_sql("primary_category = 'INCOME'")}) n USING (user_id)
      FULL JOIN ({_inflow_sql("primary_category = 'TRANSFER_IN'")}) t USING (user_id))"""


@query("flow_metrics", with_views("outflow", _FLOW))
def flow_metrics(v: Views):
    return flow.flow_metrics(v.tx())


@query("income_totals", with_views("tx", _inflow_sql("primary_category = 'INCOME'")))
def income_totals(v: Views):
    return flow.inflow_totals(v.tx(), spending.INCOME)


# --- history before the anchor --------------------------------------------------------------


@query("transactions_before_anchor", with_views("tx_before", "SELECT * FROM tx_before"))
def transactions_before_anchor(v: Views):
    return diversity.before_anchor(v.tx(), v.fa())


@query(
    "transactions_in_lookback",
    with_views("tx_before", "SELECT * FROM tx_before WHERE date >= underwritten_at - INTERVAL 60 DAY"),
)
def transactions_in_lookback(v: Views):
    return diversity.before_anchor(v.tx(), v.fa(), 60)


_DAYS = "CAST(floor(date_diff('microsecond', {0}, {1}) / 86400000000.0) AS BIGINT)"


@query(
    "whole_days",
    f"""SELECT user_id, {_DAYS.format("min(ts)", "max(ts)")} AS forward,
        {_DAYS.format("max(ts)", "min(ts)")} AS backward FROM events GROUP BY user_id""",
)
def whole_days_query(v: Views):
    ends = v.table("events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return ends.select(
        "user_id",
        whole_days(F.col("b"), F.col("a")).alias("forward"),
        whole_days(F.col("a"), F.col("b")).alias("backward"),
    )


def _history_sql(source: str, fa: str, lookbacks, over: str = "transactions") -> str:
    """All diversity features, with plain distinct counts and one join per block."""
    base = "sum(cnt) * sum(cnt)" if over == "transactions" else "count(*) * count(*)"
    windows = "".join(
        f""",
        count(DISTINCT merchant_name) FILTER (WHERE date >= underwritten_at - INTERVAL {n} DAY) AS unique_merchants_{n}d,
        count(DISTINCT primary_category) FILTER (WHERE date >= underwritten_at - INTERVAL {n} DAY) AS unique_categories_{n}d,
        count(id) FILTER (WHERE date >= underwritten_at - INTERVAL {n} DAY) AS transaction_count_{n}d"""
        for n in lookbacks
    )
    return f"""
      WITH history AS (
        SELECT user_id, count(DISTINCT merchant_name) AS unique_merchants_all_time,
          count(DISTINCT primary_category) AS unique_categories_all_time,
          count(DISTINCT detailed_category) AS unique_detailed_categories,
          count(id) AS total_transactions_all_time,
          greatest({_DAYS.format("min(date)", "max(date)")}, 0) AS time_span_days,
          {_DAYS.format("max(date)", "any_value(underwritten_at)")} AS days_since{windows}
        FROM {source} GROUP BY user_id),
      merchants AS (
        SELECT user_id, CAST(sum(cnt * cnt) AS DOUBLE) / CAST({base} AS DOUBLE) AS concentration,
               count(*) FILTER (WHERE cnt >= 3) AS recurring
        FROM (SELECT user_id, merchant_name, count(*) AS cnt FROM {source}
              WHERE merchant_name IS NOT NULL GROUP BY ALL) GROUP BY user_id)
      SELECT a.user_id, h.* EXCLUDE (user_id), m.concentration, m.recurring,
             CAST(total_transactions_all_time AS DOUBLE)
               / CASE WHEN time_span_days = 0 THEN 1 ELSE time_span_days END AS frequency
      FROM {fa} a LEFT JOIN history h USING (user_id) LEFT JOIN merchants m USING (user_id)"""


def _diversity_select(lookbacks) -> str:
    same = [c for c in diversity.diversity_columns(lookbacks) if c not in _RENAMED]
    columns = [f"coalesce({c}, 0) AS {c}" for c in same]
    columns += [f"coalesce({source}, 0) AS {name}" for name, source in _RENAMED.items()]
    return ", ".join(columns)


_RENAMED = {
    "merchant_concentration": "concentration",
    "recurring_merchants_count": "recurring",
    "transaction_frequency_all_time": "frequency",
    "days_since_last_transaction": "days_since",
}


@query(
    "diversity_features",
    with_views(
        "tx_before",
        f"SELECT user_id, {_diversity_select((30, 60, 90))} FROM ({_history_sql('tx_before', 'fa', (30, 60, 90))})",
    ),
)
def diversity_features(v: Views):
    return diversity.diversity_features(v.tx(), v.fa())


@query(
    "diversity_all_time",
    with_views("tx_before", f"SELECT user_id, {_diversity_select(())} FROM ({_history_sql('tx_before', 'fa', ())})"),
)
def diversity_all_time(v: Views):
    return diversity.diversity_features(v.tx(), v.fa(), ())


@query(
    "diversity_lookback",
    with_views(
        "tx_before",
        """SELECT fa.user_id, count(DISTINCT merchant_name) AS unique_merchants_60d,
           count(DISTINCT primary_category) AS unique_categories_60d, count(id) AS transaction_count_60d
           FROM fa LEFT JOIN (SELECT * FROM tx_before WHERE date >= underwritten_at - INTERVAL 60 DAY) t
             ON fa.user_id = t.user_id GROUP BY fa.user_id""",
    ),
)
def diversity_lookback(v: Views):
    window = ["unique_merchants_60d", "unique_categories_60d", "transaction_count_60d"]
    return diversity.diversity_features(v.tx(), v.fa(), (60,)).select("user_id", *window)


@query(
    "diversity_exploratory",
    with_views(
        "tx_before",
        f"""SELECT * EXCLUDE (time_span_days, days_since_last_transaction),
            CASE WHEN known THEN days_since_last_transaction
                 ELSE coalesce(max(days_since_last_transaction) FILTER (WHERE known) OVER (), 0) END
              AS days_since_last_transaction,
            CAST(recurring_merchants_count AS DOUBLE)
              / CASE WHEN unique_merchants_all_time = 0 THEN 1 ELSE unique_merchants_all_time END
              AS recurring_merchant_pct
            FROM (SELECT user_id, {_diversity_select((30, 60, 90))}, days_since IS NOT NULL AS known
                  FROM ({_history_sql('tx_before', 'fa', (30, 60, 90), 'merchants')}))""".replace(
            "SELECT * EXCLUDE (time_span_days,", "SELECT * EXCLUDE (known, time_span_days,", 1
        ),
    ),
)
def diversity_exploratory(v: Views):
    return diversity.diversity_features(v.tx(), v.fa(), variant="exploratory")


@query(
    "diversity_events",
    with_views(
        "event_tx event_anchor",
        f"""SELECT user_id, {_diversity_select((1, 7, 14))} FROM ({_history_sql(
            "(SELECT e.*, underwritten_at FROM event_tx e JOIN event_anchor USING (user_id) WHERE date < underwritten_at)",
            "event_anchor", (1, 7, 14))})""",
    ),
)
def diversity_events(v: Views):
    return diversity.diversity_features(v.event_tx(), v.event_anchor(), (1, 7, 14))


_COUNTS = """(SELECT user_id, merchant_name, count(*) AS cnt FROM tx_before
              WHERE merchant_name IS NOT NULL GROUP BY ALL)"""


@query(
    "merchant_concentration",
    with_views(
        "tx_before",
        f"""SELECT user_id, CAST(sum(cnt * cnt) AS DOUBLE) / CAST(sum(cnt) * sum(cnt) AS DOUBLE)
            AS merchant_concentration FROM {_COUNTS} GROUP BY user_id""",
    ),
)
def merchant_concentration(v: Views):
    return diversity.merchant_concentration(diversity.before_anchor(v.tx(), v.fa()))


@query(
    "merchant_concentration_distinct",
    with_views(
        "tx_before",
        f"""SELECT user_id, CAST(sum(cnt * cnt) AS DOUBLE) / CAST(count(*) * count(*) AS DOUBLE)
            AS merchant_concentration FROM {_COUNTS} GROUP BY user_id""",
    ),
)
def merchant_concentration_distinct(v: Views):
    return diversity.merchant_concentration(diversity.before_anchor(v.tx(), v.fa()), "merchants")


@query(
    "recurring_merchants",
    with_views(
        "tx_before",
        f"""SELECT user_id, count(*) FILTER (WHERE cnt >= 3) AS recurring_merchants_count,
            count(*) AS unique_merchants,
            CAST(count(*) FILTER (WHERE cnt >= 3) AS DOUBLE) / count(*) AS recurring_merchant_pct
            FROM {_COUNTS} GROUP BY user_id""",
    ),
)
def recurring_merchants(v: Views):
    return diversity.recurring_merchants(diversity.before_anchor(v.tx(), v.fa()))


@query(
    "fill_with_max",
    with_views(
        "tx_before",
        """SELECT user_id, coalesce(last_amount, max(last_amount) OVER (), 0) AS last_amount FROM (
           SELECT fa.user_id, m.last_amount FROM fa LEFT JOIN (
             SELECT user_id, max(amount) AS last_amount FROM tx_before GROUP BY user_id) m USING (user_id))""",
    ),
)
def fill_with_max(v: Views):
    fa = v.fa()
    largest = diversity.per_user(diversity.before_anchor(v.tx(), fa), F.max("amount").alias("last_amount"))
    return diversity.fill_with_max(fa.select("user_id").join(largest, "user_id", "left"), "last_amount")


@query(
    "attach_feature_blocks",
    with_views(
        "tx_before",
        f"""SELECT user_id, coalesce(concentration, 0) AS merchant_concentration,
            coalesce(recurring, 0) AS recurring_merchants_count,
            coalesce(transaction_count_30d, 0) AS count_30d, coalesce(transaction_count_90d, 0) AS count_90d
            FROM ({_history_sql('tx_before', 'fa', (30, 90))})""",
    ),
)
def attach_feature_blocks(v: Views):
    """Both blocks and both windows come from one pass over the transactions, so one join attaches them all."""
    features = diversity.diversity_features(v.tx(), v.fa(), (30, 90))
    windows = [F.col(f"transaction_count_{n}d").alias(f"count_{n}d") for n in (30, 90)]
    block = features.select("user_id", "merchant_concentration", "recurring_merchants_count", *windows)
    return supervised.assemble(v.fa().select("user_id"), [block])


# --- the supervised table -------------------------------------------------------------------


@query(
    "binary_columns",
    """SELECT 0 AS position, 'doc_id' AS column_name, bool_and(doc_id IN (0, 1)) AS is_binary FROM labels
       UNION ALL SELECT 1, 'quality', bool_and(quality IN (0, 1)) FROM labels
       UNION ALL SELECT 2, 'toxic', bool_and(toxic IN (0, 1)) FROM labels""",
)
def binary_columns(v: Views):
    return supervised.binary_columns(v.table("labels"))


@query(
    "labelled_users",
    with_views("adv adv_labels fa", "SELECT DISTINCT user_id, target FROM fa JOIN adv_labels ON request_id = advance_id"),
)
def labelled_users(v: Views):
    return supervised.labelled_users(cohort.label_join(v.fa(), v.adv_labels()), "target")


def _supervised_sql() -> str:
    shares = ", ".join(f'coalesce(s."{c}", 0) AS "{c}"' for c in CATEGORIES)
    flows = ", ".join(f"coalesce(f.{c}, 0) AS {c}" for c in flow.FLOW_COLUMNS)
    rest = ", ".join(f"d.{c}" for c in diversity.diversity_columns())
    return with_views(
        "tx_before outflow adv_labels",
        f"""SELECT u.user_id, u.request_id, u.target, {shares}, coalesce(s.total_spending, 0) AS total_spending,
            {rest}, {flows}
            FROM (SELECT DISTINCT user_id, request_id, target FROM fa JOIN adv_labels ON request_id = advance_id) u
            LEFT JOIN ({_SHARES}, total_spending FROM ({_PIVOT})) s USING (user_id)
            LEFT JOIN (SELECT user_id, {_diversity_select((30, 60, 90))}
                       FROM ({_history_sql('tx_before', 'fa', (30, 60, 90))})) d USING (user_id)
            LEFT JOIN ({_FLOW}) f USING (user_id)""",
    )


@query("supervised_table", _supervised_sql())
def supervised_table(v: Views):
    return features.supervised_table(v.adv(), v.adv_labels(), v.tx())


@query("supervised_as_of", _supervised_sql().replace(
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    """FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN (SELECT o_custkey AS k, min(o_orderdate) FILTER (WHERE o_orderpriority <> '4-NOT SPECIFIED') AS t
             FROM orders GROUP BY o_custkey) ON k = o_custkey AND l_shipdate < t"""))
def supervised_as_of(v: Views):
    return features.supervised_table(v.adv(), v.adv_labels(), v.tx(), as_of=True)


def _exploratory_sql() -> str:
    """The supervised table with the exploratory features in place of the standard ones."""
    sql = _supervised_sql()
    standard = ", ".join(f"d.{c}" for c in diversity.diversity_columns())
    names = [c for c in diversity.diversity_columns() if c != "time_span_days"] + ["recurring_merchant_pct"]
    assert standard in sql
    sql = sql.replace(standard, ", ".join(f"d.{c}" for c in names))
    history = f"SELECT user_id, {_diversity_select((30, 60, 90))}\n                       FROM ({_history_sql('tx_before', 'fa', (30, 60, 90))})"
    assert history in sql
    same = [c for c in diversity.diversity_columns() if c not in _RENAMED]
    columns = [f"coalesce({c}, 0) AS {c}" for c in same]
    columns += [f"coalesce({source}, 0) AS {name}" for name, source in _RENAMED.items() if source != "days_since"]
    columns += [
        "coalesce(days_since, (SELECT max(days_since) FROM x), 0) AS days_since_last_transaction",
        "coalesce(CAST(recurring AS DOUBLE) / CASE WHEN unique_merchants_all_time = 0 THEN 1 "
        "ELSE unique_merchants_all_time END, 0) AS recurring_merchant_pct",
    ]
    labelled = "(SELECT DISTINCT user_id FROM fa JOIN adv_labels ON request_id = advance_id)"
    known = f"WITH x AS (SELECT * FROM ({_history_sql('tx_before', 'fa', (30, 60, 90), over='merchants')}) WHERE user_id IN {labelled})"
    return sql.replace(history, f"{known} SELECT user_id, {', '.join(columns)} FROM x")


@query("supervised_exploratory", _exploratory_sql())
def supervised_exploratory(v: Views):
    return features.supervised_table(v.adv(), v.adv_labels(), v.tx(), variant="exploratory")


@query("supervised_incremental", _supervised_sql())
def supervised_incremental(v: Views):
    """The supervised table from transactions that are folded in file by file, here by return flag."""
    tx, joined = v.tx(), stage(cohort.label_join(v.fa(), v.adv_labels()), "cohort")
    state = FeatureState(v.spark, staging_path(v.spark, "state"))
    state.begin(joined.select("user_id", "underwritten_at").distinct())
    known = F.coalesce(F.col("amount") < 0, F.lit(False))
    state.append(tx.where(known))
    state.append(tx.where(~known))
    return supervised.assemble(supervised.labelled_users(joined, "target", ("user_id", "request_id")), [state.features()])
