"""Splits, ranks and metrics over scored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlift.catalog.registry import SQL, query
from ledgerlift.catalog.views import Views, with_views
from ledgerlift.operators import evaluate, importance, rank, scale, split

CUTOFFS = (0.05, 0.07, 0.1, 0.2, 0.29, 0.3, 0.5)
_PLACED = """SELECT *, row_number() OVER (ORDER BY y, md5(concat(id, '|', '42')), id) AS place FROM scored"""
_RANKED = "SELECT *, row_number() OVER (ORDER BY p DESC, id) AS rank FROM scored"
_PRED = "CAST(p >= CAST(0.5 AS DOUBLE) AS INTEGER)"


@query("global_rank", with_views("scored", _RANKED))
def global_rank(v: Views):
    return rank.global_rank(v.scored())


@query(
    "cumulative_precision",
    with_views(
        "scored",
        f"""SELECT *, CAST(positives AS DOUBLE) / rank AS precision FROM (
            SELECT *, CAST(sum(y) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS BIGINT) AS positives
            FROM ({_RANKED}))""",
    ),
)
def cumulative_precision(v: Views):
    return rank.cumulative_precision(v.scored())


_K = "greatest(1, CAST(ceil(c * (SELECT CAST(count(*) AS DOUBLE) FROM scored)) AS BIGINT))"


@query(
    "precision_at_cutoffs",
    with_views(
        "scored",
        f"""SELECT CAST(trunc(c * CAST(100 AS DOUBLE)) AS INTEGER) AS cutoff_pct, {_K} AS k,
            CAST(sum(y) AS DOUBLE) / {_K} AS precision
            FROM ({_RANKED}) JOIN (SELECT unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in CUTOFFS)}]) AS c)
              ON rank <= {_K}
            GROUP BY c""",
    ),
)
def precision_at_cutoffs(v: Views):
    return evaluate.precision_at_cutoffs(v.scored(), CUTOFFS)


_BINS = "(SELECT CAST(i AS DOUBLE) / 10 AS bin_lo, CAST(i + 1 AS DOUBLE) / 10 AS bin_hi FROM range(10) r(i))"
_BY_BIN = f"""SELECT bin_lo, bin_hi, count(p) AS n, CAST(sum(y) AS DOUBLE) / nullif(count(p), 0) AS precision
    FROM {_BINS} LEFT JOIN scored ON p >= bin_lo AND (p < bin_hi OR (bin_hi >= 1 AND p <= bin_hi))
    GROUP BY bin_lo, bin_hi"""


@query("precision_by_bins", with_views("scored", _BY_BIN))
def precision_by_bins(v: Views):
    return evaluate.precision_by_bins(v.scored())


@query("calibration", with_views("scored", f"SELECT *, 100 * (bin_lo + bin_hi) / 2 AS center_pct FROM ({_BY_BIN})"))
def calibration(v: Views):
    return evaluate.calibration(v.scored())


@query(
    "precision_at_threshold",
    with_views("scored", f"""SELECT coalesce(CAST(sum(y) FILTER (WHERE {_PRED} = 1) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE {_PRED} = 1), 0), 0) AS precision FROM scored"""),
)
def precision_at_threshold(v: Views):
    return evaluate.precision_at_threshold(v.scored())


def _auroc_sql(source: str) -> str:
    return f"""SELECT fold, (sum(r) FILTER (WHERE y = 1) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2)
          / (CAST(sum(y) AS DOUBLE) * (count(*) - sum(y))) AS auroc
        FROM (SELECT fold, y, rank() OVER (PARTITION BY fold ORDER BY p)
                + (count(*) OVER (PARTITION BY fold, p) - 1) / CAST(2 AS DOUBLE) AS r FROM {source})
        GROUP BY fold"""


@query("auroc", with_views("scored", f"SELECT round(auroc, 9) AS auroc FROM ({_auroc_sql('(SELECT 0 AS fold, * FROM scored)')})"))
def auroc(v: Views):
    return evaluate.auroc(v.scored()).select(F.round("auroc", 9).alias("auroc"))


@query(
    "class_report",
    with_views(
        "scored",
        f"""WITH c AS (SELECT CAST(count(*) AS DOUBLE) AS n,
              CAST(count(*) FILTER (WHERE y = 1 AND {_PRED} = 1) AS DOUBLE) AS tp,
              CAST(count(*) FILTER (WHERE y = 0 AND {_PRED} = 1) AS DOUBLE) AS fp,
              CAST(count(*) FILTER (WHERE y = 1 AND {_PRED} = 0) AS DOUBLE) AS fn,
              CAST(count(*) FILTER (WHERE y = 0 AND {_PRED} = 0) AS DOUBLE) AS tn FROM scored),
            k AS (SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, tn + fp AS support FROM c
              UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), tp + fn FROM c),
            f AS (SELECT *, 2 * precision * recall / (precision + recall) AS f1_score FROM k),
            r AS (SELECT class, precision, recall, f1_score, support FROM f
              UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / n, n FROM c
              UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM f
              UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support),
                sum(recall * support) / sum(support), sum(f1_score * support) / sum(support), sum(support) FROM f)
            SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall,
              round(f1_score, 9) AS f1_score, CAST(support AS BIGINT) AS support FROM r""".replace("WITH c AS", "SELECT * FROM (WITH c AS", 1)
        + ")",
    ),
)
def class_report(v: Views):
    report = evaluate.class_report(v.scored())
    return report.select(
        "class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1_score")], "support"
    )


@query(
    "export_predictions",
    with_views("scored", f"SELECT id, {_PRED} AS y_pred, p AS y_pred_proba, y AS y_true FROM scored"),
)
def export_predictions(v: Views):
    from ledgerlift.session import staging_path
    from ledgerlift.sources import sinks, tables

    path = staging_path(v.spark, "predictions")
    sinks.write_csv(evaluate.predictions(v.scored(), ("id",)), path)
    return tables.read_csv(v.spark, path, "id BIGINT, y_pred INT, y_pred_proba DOUBLE, y_true INT")


# --- splits and weights ---------------------------------------------------------------------


@query(
    "stratified_split",
    with_views(
        "scored",
        f"""SELECT p.id, p.y, p.p, CASE WHEN place - start > n - train THEN 'train' ELSE 'test' END AS split
            FROM ({_PLACED}) p JOIN (
              SELECT y, n, start, floor(exact) + CAST(row_number() OVER (ORDER BY exact - floor(exact) DESC, y)
                       <= wanted - sum(floor(exact)) OVER () AS INTEGER) AS train
              FROM (SELECT y, n, wanted, coalesce(sum(n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                      CAST(n AS DOUBLE) / total * wanted AS exact
                    FROM (SELECT y, count(*) AS n, sum(count(*)) OVER () AS total,
                            sum(count(*)) OVER () - ceil(CAST(0.2 AS DOUBLE) * sum(count(*)) OVER ()) AS wanted
                          FROM scored GROUP BY y))) c ON p.y = c.y""",
    ),
)
def stratified_split(v: Views):
    return split.stratified_split(v.scored())


@query(
    "sampled_split",
    with_views(
        "scored",
        """SELECT id, y, p, CASE WHEN ('0x' || md5(id || '|42')[1:8])::BIGINT / 4294967296.0::DOUBLE < 0.2::DOUBLE
           THEN 'test' ELSE 'train' END AS split FROM scored""",
    ),
)
def sampled_split(v: Views):
    return split.sampled_split(v.scored())


@query(
    "stratified_folds",
    with_views("scored", f"SELECT id, y, p, CAST((place - 1) % 5 AS INTEGER) AS fold FROM ({_PLACED})"),
)
def stratified_folds(v: Views):
    return split.stratified_folds(v.scored())


@query(
    "class_weights",
    with_views("scored", """SELECT y, count(*) AS n,
        CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight FROM scored GROUP BY y"""),
)
def class_weights(v: Views):
    return split.class_weights(v.scored())


@query(
    "row_weights",
    with_views("scored", """SELECT id, s.y, p, weight FROM scored s JOIN (SELECT y,
        CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight FROM scored GROUP BY y) w
        ON s.y = w.y"""),
)
def row_weights(v: Views):
    return split.with_class_weights(v.scored())


@query(
    "positive_weight",
    with_views("scored", """SELECT avg(y) AS positive_rate, (1 - avg(y)) / greatest(avg(y), 1e-6) AS positive_weight
        FROM scored"""),
)
def positive_weight(v: Views):
    return split.positive_weight(v.scored())


@query(
    "scale_std",
    """SELECT l_orderkey, l_linenumber, round(l_quantity / sq, 6) AS l_quantity,
       round(l_extendedprice / sp, 6) AS l_extendedprice, round(l_discount / sd, 6) AS l_discount
       FROM lineitem, (SELECT stddev_pop(l_quantity) AS sq, stddev_pop(l_extendedprice) AS sp,
                              stddev_pop(l_discount) AS sd FROM lineitem)""",
)
def scale_std(v: Views):
    columns = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = v.table("lineitem").select("l_orderkey", "l_linenumber", *columns)
    scaled = scale.scale_by_std(rows, columns)
    return scaled.withColumns({c: F.round(c, 6) for c in columns})


# --- folds ----------------------------------------------------------------------------------

_FOLDED = f"(SELECT *, (place - 1) % 5 AS fold FROM ({_PLACED}))"
_FOLD_METRICS = f"""SELECT fold, precision, auroc FROM (
      SELECT fold, coalesce(CAST(sum(y) FILTER (WHERE {_PRED} = 1) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE {_PRED} = 1), 0), 0) AS precision FROM {_FOLDED} GROUP BY fold)
    JOIN ({_auroc_sql(_FOLDED)}) USING (fold)"""


@query(
    "fold_metrics",
    with_views("scored", f"""SELECT CAST(fold AS INTEGER) AS fold, precision, round(auroc, 9) AS auroc
        FROM ({_FOLD_METRICS})"""),
)
def fold_metrics(v: Views):
    return evaluate.fold_metrics(split.stratified_folds(v.scored())).withColumn("auroc", F.round("auroc", 9))


@query(
    "metric_summary",
    with_views(
        "scored",
        f"""SELECT round(avg(precision), 9) AS precision_mean, round(stddev_pop(precision), 9) AS precision_std,
            round(avg(auroc), 9) AS auroc_mean, round(stddev_pop(auroc), 9) AS auroc_std FROM ({_FOLD_METRICS})""",
    ),
)
def metric_summary(v: Views):
    summary = evaluate.metric_summary(evaluate.fold_metrics(split.stratified_folds(v.scored())))
    return summary.select(*[F.round(c, 9).alias(c) for c in summary.columns])


@query(
    "meta_weighted_importance",
    """SELECT feature, round(sum(abs(w) * importance), 6) AS importance
       FROM (SELECT event_type AS model, props AS feature, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS importance
             FROM events GROUP BY ALL)
       JOIN (SELECT event_type AS model,
                    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) - CAST(0.2 AS DOUBLE) AS w
             FROM events GROUP BY ALL) USING (model)
       WHERE model <> 'error' AND w <> 0 GROUP BY feature""",
)
def meta_weighted_importance(v: Views):
    """Event types as models and event properties as features."""
    from ledgerlift.functions.arithmetic import exact_sum

    events = v.table("events").withColumn("model", F.col("event_type"))
    importances = events.groupBy("model", F.col("props").alias("feature")).agg(
        exact_sum(F.col("value")).alias("importance")
    )
    counts = events.groupBy("model").agg(F.count(F.lit(1)).alias("n"))
    total = events.agg(F.count(F.lit(1))).scalar()
    weights = counts.select("model", (F.col("n").cast("double") / total - F.lit(0.2)).alias("weight"))
    combined = importance.meta_weighted(importances, weights, skip=("error",))
    return combined.withColumn("importance", F.round("importance", 6))


@query(
    "top_features",
    f"""SELECT feature, importance FROM ({SQL["meta_weighted_importance"]}) ORDER BY importance DESC, feature LIMIT 20""",
)
def top_features(v: Views):
    """The 20 event properties of greatest weighted importance."""
    return importance.top_features(meta_weighted_importance(v), 20)
