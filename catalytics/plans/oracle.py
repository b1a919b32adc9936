"""DuckDB SQL for each registered query: an independent engine computing the
same answer over the same Parquet tables (views named after the tables)."""

RATING = "p_size / CAST(10 AS DOUBLE)"

ORACLE_SQL = {
    "top_groups_by_mean": """
        SELECT p_brand, COUNT(*) AS total_apps, ROUND(AVG(p_retailprice), 0) AS avg_installs
        FROM part
        GROUP BY p_brand
        ORDER BY avg_installs DESC NULLS LAST, p_brand ASC NULLS LAST
        LIMIT 10
    """,
    "mean_by_rounded_level": f"""
        SELECT ROUND({RATING}) AS rating_level, COUNT(*) AS total_apps,
               ROUND(AVG(p_retailprice), 0) AS avg_installs
        FROM part
        WHERE {RATING} IS NOT NULL
        GROUP BY ROUND({RATING})
        ORDER BY rating_level DESC
    """,
    "top_groups_min_size": f"""
        SELECT p_brand, COUNT(*) AS app_count, ROUND(AVG({RATING}), 2) AS avg_rating
        FROM part
        WHERE {RATING} IS NOT NULL
        GROUP BY p_brand
        HAVING COUNT(*) >= 75
        ORDER BY avg_rating DESC NULLS LAST, app_count DESC NULLS LAST, p_brand ASC NULLS LAST
        LIMIT 10
    """,
    "mean_by_flag": """
        SELECT CASE WHEN l_tax = 0 THEN 'Free' ELSE 'Paid' END AS app_type,
               COUNT(*) AS total_apps, ROUND(AVG(l_extendedprice), 2) AS avg_installs
        FROM lineitem
        GROUP BY 1
        ORDER BY avg_installs DESC
    """,
    "mean_by_band": """
        WITH o AS (
            SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER)
                       AS app_age_days,
                   o_totalprice
            FROM orders
        )
        SELECT band.label AS app_age_group, count(*) AS total_apps, round(avg(o.o_totalprice), 0) AS avg_installs
        FROM o ASOF JOIN (VALUES (-1000000, 'Less than 1 year'), (365, '1 to 3 years'),
                                 (1095, '3 to 5 years'), (1825, 'More than 5 years')) band(low, label)
             ON o.app_age_days >= band.low
        GROUP BY band.label
    """,
    "best_subgroup_per_group": """
        SELECT p_brand, p_type, count(*) AS total_apps, round(avg(p_retailprice), 0) AS avg_installs
        FROM part
        WHERE p_type IS NOT NULL
        GROUP BY p_brand, p_type
        QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY round(avg(p_retailprice), 0) DESC NULLS LAST, p_type) = 1
        ORDER BY avg_installs DESC NULLS LAST, p_brand NULLS LAST
        LIMIT 15
    """,
    "numeric_summary": """
        SELECT COUNT(*) AS total_apps,
               COUNT(DISTINCT l_returnflag) AS distinct_categories,
               ROUND(AVG(l_tax), 2) AS avg_price,
               ROUND(VAR_SAMP(l_tax), 2) AS price_variance,
               ROUND(AVG(l_extendedprice), 2) AS avg_installs,
               ROUND(VAR_SAMP(l_extendedprice), 2) AS installs_variance,
               QUANTILE_DISC(l_tax, 0.5) AS median_price,
               QUANTILE_DISC(l_extendedprice, 0.25) AS installs_p25,
               QUANTILE_DISC(l_extendedprice, 0.5) AS median_installs,
               QUANTILE_DISC(l_extendedprice, 0.75) AS installs_p75
        FROM lineitem
        WHERE l_tax IS NOT NULL AND l_extendedprice IS NOT NULL
    """,
    "top_groups_by_total": """
        WITH t AS (
            SELECT o_custkey, CAST(SUM(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS total_installs
            FROM orders
            WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
            GROUP BY o_custkey
        )
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_installs DESC, o_custkey) AS INTEGER) AS position,
               o_custkey, total_installs
        FROM t
        ORDER BY total_installs DESC, o_custkey
        LIMIT 10
    """,
    "category_group_count": """
        SELECT COUNT(DISTINCT o_custkey) AS n_groups
        FROM orders
        WHERE o_custkey IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
    """,
    "rating_bucket_stats": f"""
        WITH r AS (
            SELECT {RATING} AS rating, CAST(trunc(p_retailprice) AS BIGINT) AS v
            FROM part
            WHERE p_brand IS NOT NULL AND p_size IS NOT NULL
              AND p_retailprice IS NOT NULL AND NOT isnan(p_retailprice)
        )
        SELECT CASE WHEN rating < 1.0 THEN '0-1' WHEN rating < 2.0 THEN '1-2'
                    WHEN rating < 3.0 THEN '2-3' WHEN rating < 4.0 THEN '3-4'
                    ELSE '4-5' END AS bucket,
               COUNT(*) AS app_count,
               ROUND(AVG(v), 2) AS avg_installs
        FROM r
        WHERE rating BETWEEN 0 AND 5
        GROUP BY 1
        ORDER BY bucket
    """,
}

from catalytics.plans.oracle_catalogue import CATALOGUE_ORACLE  # noqa: E402

_SLOT = "((((o_orderkey % 4294967296) + 4294967296) % 4294967296) * 40503 % 65536) / CAST(65536 AS DOUBLE)"
_LSLOT = _SLOT.replace("o_orderkey", "l_orderkey")
_SCORED = """scored AS (
    SELECT l_orderkey, l_extendedprice AS label, l_extendedprice * (1 - l_discount) AS prediction
    FROM lineitem)"""
_METRICS = """COUNT(*) AS n,
    ROUND(sqrt(AVG((prediction - label) * (prediction - label))), 6) AS rmse,
    ROUND(AVG(abs(prediction - label)), 6) AS mae,
    ROUND(1 - SUM((prediction - label) * (prediction - label)) / (VAR_POP(label) * COUNT(*)), 6) AS r2"""
_BASE = f"""{_SCORED},
    train AS (SELECT * FROM scored WHERE {_LSLOT} < 0.7),
    test AS (SELECT * FROM scored WHERE {_LSLOT} >= 0.7),
    m AS (SELECT AVG(label) AS mean_label FROM train),
    base AS (
        SELECT ROUND((SELECT mean_label FROM m), 6) AS baseline_prediction, COUNT(*) AS n,
               ROUND(sqrt(AVG(((SELECT mean_label FROM m) - label) * ((SELECT mean_label FROM m) - label))), 6) AS rmse,
               ROUND(AVG(abs((SELECT mean_label FROM m) - label)), 6) AS mae,
               ROUND(1 - SUM(((SELECT mean_label FROM m) - label) * ((SELECT mean_label FROM m) - label))
                     / (VAR_POP(label) * COUNT(*)), 6) AS r2
        FROM test)"""

ORACLE_SQL.update(CATALOGUE_ORACLE)
ORACLE_SQL.update(
    {
        "csv_scan": CATALOGUE_ORACLE["raw_catalogue"],
        "sql_query": ORACLE_SQL["top_groups_min_size"],
        "date_features": """
            SELECT o_orderkey,
                   CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS INTEGER) AS days_since,
                   CASE WHEN dayofweek(CAST(o_orderdate AS DATE)) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
            FROM orders""",
        "preview": "SELECT * FROM part ORDER BY p_partkey LIMIT 10",
        "index_categories": """
            SELECT p_brand, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_brand) - 1 AS DOUBLE) AS brand_index,
                   COUNT(*) AS n
            FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand""",
        "one_hot": """
            WITH idx AS (
                SELECT p_type, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_type) - 1 AS i, COUNT(*) AS n,
                       COUNT(*) OVER () AS k
                FROM part WHERE p_type IS NOT NULL GROUP BY p_type)
            SELECT p_type, list_transform(range(k + 1), lambda j: CASE WHEN j = i THEN 1.0 ELSE 0.0 END)::DOUBLE[] AS type_ohe, n
            FROM idx""",
        "min_max_columns": """
            SELECT l_orderkey, l_linenumber,
                   (l_quantity - MIN(l_quantity) OVER ()) / (MAX(l_quantity) OVER () - MIN(l_quantity) OVER ()) AS l_quantity_scaled,
                   (l_extendedprice - MIN(l_extendedprice) OVER ()) / (MAX(l_extendedprice) OVER () - MIN(l_extendedprice) OVER ()) AS l_extendedprice_scaled,
                   (l_discount - MIN(l_discount) OVER ()) / (MAX(l_discount) OVER () - MIN(l_discount) OVER ()) AS l_discount_scaled,
                   (l_tax - MIN(l_tax) OVER ()) / (MAX(l_tax) OVER () - MIN(l_tax) OVER ()) AS l_tax_scaled
            FROM lineitem""",
        "split_by_key": f"""
            SELECT o_orderkey, o_totalprice, CASE WHEN {_SLOT} < 0.7 THEN 'train' ELSE 'test' END AS split
            FROM orders""",
        "regression_metrics": f"WITH {_SCORED} SELECT {_METRICS} FROM scored",
        "mean_baseline": f"WITH {_BASE} SELECT * FROM base",
        "compare_models": f"""WITH {_BASE},
            model AS (SELECT {_METRICS} FROM test)
            SELECT 'rmse' AS metric, model.rmse AS model, base.rmse AS baseline, model.rmse < base.rmse AS model_better FROM model, base
            UNION ALL
            SELECT 'mae', model.mae, base.mae, model.mae < base.mae FROM model, base
            UNION ALL
            SELECT 'r2', model.r2, base.r2, model.r2 > base.r2 FROM model, base""",
    }
)
