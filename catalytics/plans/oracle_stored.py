"""DuckDB SQL for the queries of ``stored``."""

from catalytics import fixed
from catalytics.plans.bindings import ORDERS_AS_OF
from catalytics.plans.catalogue import RAW_CATALOGUE_SQL
from catalytics.plans.oracle_catalogue import _ML_BASE_CTE, _ON_TRAIN, CATALOGUE_ORACLE, CLEANED_CTE, FEATURES_CTE, _q
from catalytics.plans.stored import _SAVED_ON

_WIDTH = f"""width AS (
    SELECT {len(fixed.ML_NUMERIC)} + COUNT(DISTINCT "Category") + 1 + COUNT(DISTINCT "Content Rating") + 1 AS w
    FROM base WHERE {_ON_TRAIN})"""

# Two levels of best splits: the gain of a split times its rows is what the squared sums
# of both sides, over their counts, exceed that of the whole by.
_TREE = """
    cell AS (
        SELECT l_linenumber::DOUBLE AS x0, l_discount AS x1, l_tax AS x2, COUNT(*) AS n, SUM(l_quantity::DOUBLE) AS s
        FROM lineitem GROUP BY ALL),
    long0 AS (SELECT 0 AS node, n, s, UNNEST([0, 1, 2]) AS f, UNNEST([x0, x1, x2]) AS v FROM cell),
    {cuts0},
    placed AS (
        SELECT cell.*, CASE WHEN CASE f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= t THEN 1 ELSE 2 END AS node FROM cell, cut0),
    long1 AS (SELECT node, n, s, UNNEST([0, 1, 2]) AS f, UNNEST([x0, x1, x2]) AS v FROM placed),
    {cuts1}"""


def _cuts(k: int) -> str:
    return f"""
    side{k} AS (
        SELECT a.node, a.f, b.v AS t, SUM(a.n) AS n, SUM(a.s) AS s FROM long{k} a
        JOIN (SELECT DISTINCT node, f, v FROM long{k}) b ON a.node = b.node AND a.f = b.f AND a.v <= b.v GROUP BY ALL),
    whole{k} AS (SELECT node, SUM(n) AS wn, SUM(s) AS ws FROM long{k} WHERE f = 0 GROUP BY node),
    cut{k} AS (
        SELECT node, f, t, s * s / n + (ws - s) ** 2 / (wn - n) - ws * ws / wn AS gain, s / n AS low, (ws - s) / (wn - n) AS high
        FROM side{k} JOIN whole{k} USING (node) WHERE n < wn
        QUALIFY ROW_NUMBER() OVER (PARTITION BY node ORDER BY gain DESC) = 1)"""


_TREE_CTE = _TREE.format(cuts0=_cuts(0).strip(), cuts1=_cuts(1).strip())

_CLASSES = {
    "boolean": "regexp_matches(v, '^(?i:true|false)$')",
    "long": "regexp_matches(v, '^[+-]?[0-9]{1,18}$')",
    "double": "regexp_matches(v, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')",
    "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND TRY_CAST(v AS DATE) IS NOT NULL",
    "timestamp": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
}


def _infer() -> str:
    cases = " ".join(f"WHEN {test} THEN '{name}'" for name, test in _CLASSES.items())
    names = [*_CLASSES, "text"]
    long = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS \"column\", TRIM({_q(c)}) AS v FROM raw" for i, c in enumerate(fixed.RAW_COLUMNS))
    counts = ", ".join(f"COUNT(*) FILTER (c = '{k}') AS n_{k}" for k in names)
    return f"""
        WITH raw AS ({RAW_CATALOGUE_SQL}), long AS ({long}),
        classed AS (SELECT *, CASE WHEN v IS NULL OR v = '' THEN NULL {cases} ELSE 'text' END AS c FROM long),
        counted AS (SELECT position, "column", COUNT(*) FILTER (c IS NULL) AS n_missing, {counts}, list_sort(list(DISTINCT c) FILTER (c IS NOT NULL)) AS kinds
                    FROM classed GROUP BY ALL)
        SELECT * EXCLUDE (kinds), len(coalesce(kinds, [])) > 1 AS mixed,
               CASE WHEN len(kinds) = 1 THEN kinds[1] WHEN kinds = ['double', 'long'] THEN 'double'
                    WHEN kinds = ['date', 'timestamp'] THEN 'timestamp' ELSE 'text' END AS type
        FROM counted"""


_COLUMNS_OF = {"raw": fixed.RAW_COLUMNS, "cleaned": [*fixed.RAW_COLUMNS, "Size_KB"]}

STORED_ORACLE = {
    "forest_by_tables": f"""WITH {_ML_BASE_CTE}
        SELECT split AS "set", COUNT(*) AS n, {fixed.FOREST_TREES} AS trees, 0 AS n_differing, 0.0::DOUBLE AS max_difference
        FROM base GROUP BY split""",
    "importances_by_tables": f"""WITH {_ML_BASE_CTE}, {_WIDTH}
        SELECT UNNEST(range(w)) AS slot, true AS agrees FROM width""",
    "tree_importance": f"""WITH {_TREE_CTE}
        SELECT ['l_linenumber', 'l_discount', 'l_tax'][f + 1] AS input, ROUND(SUM(gain) / SUM(SUM(gain)) OVER (), 6) AS importance
        FROM (SELECT * FROM cut0 UNION ALL SELECT * FROM cut1) GROUP BY f""",
    "tree_scores": f"""WITH {_TREE_CTE}
        SELECT x0::INTEGER AS l_linenumber, x1 AS l_discount, x2 AS l_tax, placed.n,
               ROUND(CASE WHEN CASE f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= t THEN low ELSE high END, 6) AS prediction
        FROM placed JOIN cut1 USING (node)""",
    "tree_leaves": f"""WITH {_TREE_CTE}
        SELECT ROUND(UNNEST([low, high]), 6) AS prediction, 2 AS conditions FROM cut1""",
    "model_round_trip": f"""WITH {FEATURES_CTE}
        SELECT YEAR("Last Updated") AS year, COUNT(*) AS n, 0 AS n_differing
        FROM feat WHERE "Last Updated" >= DATE '{_SAVED_ON}' GROUP BY 1""",
    "vector_width": f"WITH {_ML_BASE_CTE}, {_WIDTH} SELECT w AS width, w AS least, w AS most FROM width",
    "split_stable": """
        SELECT l_orderkey, l_linenumber,
               CASE WHEN ('0x' || substr(md5('42|=' || l_orderkey || '|=' || l_linenumber), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.7
                    THEN 0 ELSE 1 END AS part
        FROM lineitem""",
    "split_stable_sizes": """
        WITH drawn AS (
            SELECT ('0x' || substr(md5('7|=' || l_orderkey || '|=' || l_linenumber), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS r FROM lineitem)
        SELECT UNNEST([4, 64]) AS partitions, part, n, true AS within
        FROM (SELECT CASE WHEN r < 0.6 THEN 0 WHEN r < 0.9 THEN 1 ELSE 2 END AS part, COUNT(*) AS n FROM drawn GROUP BY 1)""",
    "infer_types": _infer(),
    "typed_csv": f"""
        WITH raw AS ({RAW_CATALOGUE_SQL})
        SELECT "App Name", "App Id"::BIGINT AS "App Id", "Rating"::DOUBLE AS "Rating", "Rating Count"::DOUBLE AS "Rating Count",
               "Maximum Installs"::BIGINT AS "Maximum Installs", "Free"::BOOLEAN AS "Free", "In App Purchases"::BOOLEAN AS "In App Purchases",
               "Scraped Time"::TIMESTAMP AS "Scraped Time", "Size" FROM raw""",
    "checked_csv": f"""
        WITH raw AS ({RAW_CATALOGUE_SQL}), kind AS (SELECT "App Id"::BIGINT % 10 AS k, length("App Name") AS chars FROM raw)
        SELECT CASE k WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields' ELSE 'read' END AS outcome, COUNT(*) AS n,
               SUM(CASE k WHEN 1 THEN {len(fixed.RAW_COLUMNS) - 1} WHEN 2 THEN {len(fixed.RAW_COLUMNS) + 1} WHEN 3 THEN chars + 7 ELSE chars END)::BIGINT AS total
        FROM kind GROUP BY 1""",
    "observed_stages": CATALOGUE_ORACLE["stage_report"],
    "observed_missing": f"WITH {CLEANED_CTE} "
    + " UNION ALL ".join(
        f"SELECT {step} AS step, '{stage}' AS stage, '{c}' AS \"column\", COUNT(*) FILTER ({_q(c)} IS NULL) AS n_missing FROM {stage}"
        for step, stage in ((1, "raw"), (2, "cleaned"))
        for c in _COLUMNS_OF[stage]
    ),
    "merged_sketches": """
        SELECT c AS "column", p, COUNT(*) AS n, true AS within
        FROM lineitem, (SELECT UNNEST(['l_extendedprice', 'l_quantity', 'l_discount']) AS c),
             (SELECT UNNEST([0.01, 0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS p)
        WHERE CASE c WHEN 'l_extendedprice' THEN l_extendedprice WHEN 'l_quantity' THEN l_quantity ELSE l_discount END IS NOT NULL
        GROUP BY ALL""",
    "replace_partition": f"""WITH {CLEANED_CTE}
        SELECT "Content Rating", COUNT(*) AS n, SUM("Rating Count" + CASE WHEN "Content Rating" = 'P' THEN 1000 ELSE 0 END)::BIGINT AS total,
               COUNT(DISTINCT "App Name") AS names
        FROM cleaned GROUP BY 1""",
    "hashed_categories": f"""WITH {CLEANED_CTE}
        SELECT 'App Id' AS "column", COUNT(DISTINCT "App Id") AS n_categories, COUNT(*) AS n, 0 AS n_wrong, true AS fits FROM cleaned""",
    "pipeline_hashed": f"""WITH {CLEANED_CTE},
        wide AS (SELECT 1 + COUNT(DISTINCT "Category") + 1 + COUNT(DISTINCT "Content Rating") + 1 + 256 AS w FROM cleaned)
        SELECT "Content Rating", COUNT(*) AS n, ANY_VALUE(w) AS width, COUNT("Developer Id") AS n_hashed FROM cleaned, wide GROUP BY 1""",
    "date_features_today": """
        SELECT o_orderkey, date_diff('day', o_orderdate::DATE, (current_timestamp AT TIME ZONE 'UTC')::DATE) AS days_since FROM orders""",
    "catalogue_mean_by_band_then": CATALOGUE_ORACLE["catalogue_mean_by_band"].replace(fixed.REFERENCE_DAY, ORDERS_AS_OF),
}
