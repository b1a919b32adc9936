"""DuckDB SQL for the catalogue jobs: the same derivation, typing, rules,
fills, reports and features written independently in another engine."""

from catalytics import fixed
from catalytics.plans.catalogue import RAW_CATALOGUE_SQL


def _long(d: str) -> str:
    return f"TRY_CAST(trunc({d}) AS BIGINT)"


def _flag(c: str) -> str:
    return f"CASE lower(trim({c})) WHEN 'true' THEN true WHEN 'false' THEN false END"


def _q(c: str) -> str:
    return '"' + c + '"'


_PRICE = "TRY_CAST(regexp_replace(\"Price\", '[$]', '', 'g') AS DOUBLE)"
_SIZE_NUM = "TRY_CAST(regexp_replace(\"Size\", '[^0-9.]', '', 'g') AS DOUBLE)"

TYPED_CTE = f"""
raw AS ({RAW_CATALOGUE_SQL}),
typed AS (
    SELECT
        "App Name", "App Id", "Category",
        TRY_CAST("Rating" AS DOUBLE) AS "Rating",
        {_long('TRY_CAST("Rating Count" AS DOUBLE)')} AS "Rating Count",
        {_long("TRY_CAST(regexp_replace(\"Installs\", '[+,]', '', 'g') AS DOUBLE)")} AS "Installs",
        {_long("TRY_CAST(regexp_replace(\"Minimum Installs\", ',', '', 'g') AS DOUBLE)")} AS "Minimum Installs",
        {_long("TRY_CAST(regexp_replace(\"Maximum Installs\", ',', '', 'g') AS DOUBLE)")} AS "Maximum Installs",
        CASE WHEN {_PRICE} = 0 THEN true ELSE false END AS "Free",
        {_PRICE} AS "Price",
        "Currency", "Size", "Minimum Android", "Developer Id", "Developer Website", "Developer Email",
        CAST(try_strptime(trim("Released"), '%b %-d, %Y') AS DATE) AS "Released",
        CAST(try_strptime(trim("Last Updated"), '%b %-d, %Y') AS DATE) AS "Last Updated",
        "Content Rating", "Privacy Policy",
        {_flag('"Ad Supported"')} AS "Ad Supported",
        {_flag('"In App Purchases"')} AS "In App Purchases",
        {_flag('"Editors Choice"')} AS "Editors Choice",
        try_strptime("Scraped Time", '%Y-%m-%d %H:%M:%S') AS "Scraped Time"
    FROM raw
)"""

_RULES = [
    '"Installs" >= "Minimum Installs"',
    '"Rating Count" <= "Installs"',
    '"Last Updated" >= "Released"',
    "\"Size\" <> '0'",
]

CLEANED_CTE = f"""{TYPED_CTE},
valid AS (
    SELECT *,
        CASE WHEN contains("Size", 'M') THEN {_SIZE_NUM} * 1024.0
             WHEN contains("Size", 'k') THEN {_SIZE_NUM} END AS "Size_KB"
    FROM typed
    WHERE {' AND '.join(_RULES)}
),
med AS (SELECT quantile_disc("Size_KB", 0.5) AS m FROM valid WHERE NOT isnan("Size_KB")),
cleaned AS (
    SELECT * REPLACE (
        COALESCE("Size_KB", (SELECT m FROM med)) AS "Size_KB",
        COALESCE("Developer Website", 'Unknown') AS "Developer Website",
        COALESCE("Privacy Policy", 'Unknown') AS "Privacy Policy",
        COALESCE("Minimum Android", 'Varies with device') AS "Minimum Android",
        CASE WHEN "Currency" IS NULL OR "Currency" = 'XXX' THEN 'USD' ELSE "Currency" END AS "Currency"
    )
    FROM valid
    WHERE "Developer Id" IS NOT NULL AND "Developer Email" IS NOT NULL
)"""

_DROP = ", ".join(_q(c) for c in fixed.REDUCTION_DROP)

FEATURES_CTE = f"""{CLEANED_CTE},
reduced AS (SELECT * EXCLUDE ({_DROP}) FROM cleaned),
feat AS (
    SELECT *,
        TRY_CAST(regexp_extract("Minimum Android", '([0-9]+\\.?[0-9]*)', 1) AS DOUBLE) AS min_android_version,
        CAST(date_diff('day', "Last Updated", DATE '{fixed.REFERENCE_DAY}') AS INTEGER) AS days_since_update,
        CAST(date_diff('day', "Released", DATE '{fixed.REFERENCE_DAY}') AS INTEGER) AS app_age_days,
        CASE WHEN dayofweek("Last Updated") IN (0, 6) THEN 1 ELSE 0 END AS is_weekend_update,
        CAST("Ad Supported" AS DOUBLE) AS ad_supported_num,
        CAST("In App Purchases" AS DOUBLE) AS in_app_purchases_num,
        CAST("Editors Choice" AS DOUBLE) AS editors_choice_num
    FROM reduced
)"""


def _rule_report() -> str:
    names = ["installs_at_least_minimum", "rating_count_at_most_installs", "updated_not_before_release", "size_not_zero"]
    aggs = ["COUNT(*) AS r0"]
    acc = []
    for i, r in enumerate(_RULES, start=1):
        acc.append(f"COALESCE({r}, false)")
        aggs.append(f"COUNT_IF({' AND '.join(acc)}) AS r{i}")
    parts = [
        f"SELECT {i} AS step, '{n}' AS rule, r{i - 1} AS rows_before, r{i - 1} - r{i} AS rows_lost, r{i} AS rows_after FROM c"
        for i, n in enumerate(names, start=1)
    ]
    return f"WITH {TYPED_CTE}, c AS (SELECT {', '.join(aggs)} FROM typed) " + " UNION ALL ".join(parts)


def _outlier_report(columns, k=fixed.OUTLIER_FENCE) -> str:
    parts = []
    for c in columns:
        v = f"CAST({_q(c)} AS DOUBLE)"
        parts.append(
            f"""SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr,
                   q1 - {k} * (q3 - q1) AS lower, q3 + {k} * (q3 - q1) AS upper,
                   (SELECT COUNT_IF({v} < q1 - {k} * (q3 - q1) OR {v} > q3 + {k} * (q3 - q1)) FROM cleaned)
                       AS n_outliers
               FROM (SELECT quantile_disc({v}, 0.25) AS q1, quantile_disc({v}, 0.75) AS q3
                     FROM cleaned WHERE {v} IS NOT NULL AND NOT isnan({v}))"""
        )
    return f"WITH {CLEANED_CTE} " + " UNION ALL ".join(parts)


def _impute(columns) -> str:
    meds = ", ".join(
        f"quantile_disc(CAST({_q(c)} AS DOUBLE), 0.5) FILTER (WHERE {_q(c)} IS NOT NULL AND NOT isnan(CAST({_q(c)} AS DOUBLE))) AS m{i}"
        for i, c in enumerate(columns)
    )
    outs = ", ".join(
        f"CASE WHEN {_q(c)} IS NULL OR isnan(CAST({_q(c)} AS DOUBLE)) THEN (SELECT m{i} FROM meds) "
        f"ELSE CAST({_q(c)} AS DOUBLE) END AS {_q(c + fixed.IMPUTED_SUFFIX)}"
        for i, c in enumerate(columns)
    )
    return f"WITH {FEATURES_CTE}, meds AS (SELECT {meds} FROM feat) SELECT *, {outs} FROM feat"


CATALOGUE_ORACLE = {
    "raw_catalogue": f"WITH {TYPED_CTE} SELECT * FROM raw",
    "type_catalogue": f"WITH {TYPED_CTE} SELECT * FROM typed",
    "rule_report": _rule_report(),
    "clean_catalogue": f"WITH {CLEANED_CTE} SELECT * FROM cleaned",
    "outlier_report": _outlier_report(fixed.OUTLIER_COLUMNS),
    "duplicate_keys": f'WITH {CLEANED_CTE} SELECT "App Id", COUNT(*) AS count FROM cleaned GROUP BY 1 HAVING COUNT(*) > 1',
    "duplicate_key_count": f'WITH {CLEANED_CTE} SELECT COUNT(*) AS duplicate_keys FROM (SELECT "App Id" FROM cleaned GROUP BY 1 HAVING COUNT(*) > 1)',
    "stage_report": f"""WITH {CLEANED_CTE}
        SELECT 1 AS step, 'raw' AS stage, (SELECT COUNT(*) FROM raw) AS rows, 24 AS columns
        UNION ALL
        SELECT 2 AS step, 'cleaned' AS stage, (SELECT COUNT(*) FROM cleaned) AS rows, 25 AS columns""",
    "reduce_columns": f"WITH {CLEANED_CTE} SELECT * EXCLUDE ({_DROP}) FROM cleaned",
    "catalogue_features": f"WITH {FEATURES_CTE} SELECT * FROM feat",
    "impute_median": _impute(fixed.ML_NUMERIC),
}


_IDS = '"App Name", "App Id"'
_FLAG_AD = _flag('"Ad Supported"')

CATALOGUE_ORACLE.update(
    {
        "parse_numbers": f"""WITH {TYPED_CTE}
            SELECT {_IDS}, "Installs" AS installs, "Minimum Installs" AS min_installs,
                   "Maximum Installs" AS max_installs, "Price" AS price, "Rating" AS rating,
                   "Rating Count" AS rating_count
            FROM typed""",
        "parse_dates": f"""WITH {TYPED_CTE}
            SELECT {_IDS}, "Released" AS released, "Last Updated" AS updated, "Scraped Time" AS scraped
            FROM typed""",
        "parse_sizes": f"""WITH raw AS ({RAW_CATALOGUE_SQL})
            SELECT {_IDS}, "Size",
                   CASE WHEN contains("Size", 'M') THEN {_SIZE_NUM} * 1024.0
                        WHEN contains("Size", 'k') THEN {_SIZE_NUM} END AS size_kb
            FROM raw""",
        "parse_flags": f"""WITH raw AS ({RAW_CATALOGUE_SQL})
            SELECT {_IDS}, {_FLAG_AD} AS ad_supported, CAST({_FLAG_AD} AS DOUBLE) AS ad_supported_num,
                   {_flag('"Editors Choice"')} AS editors_choice,
                   CASE WHEN {_PRICE} = 0 THEN true ELSE false END AS free
            FROM raw""",
        "parse_versions": f"""WITH raw AS ({RAW_CATALOGUE_SQL})
            SELECT {_IDS}, "Minimum Android",
                   TRY_CAST(regexp_extract("Minimum Android", '([0-9]+\\.?[0-9]*)', 1) AS DOUBLE) AS version
            FROM raw""",
        "enforce_rules": f"WITH {TYPED_CTE} SELECT * FROM typed WHERE {' AND '.join(_RULES)}",
        "fill_median": f"""WITH {CLEANED_CTE}
            SELECT {_IDS}, "Size", COALESCE("Size_KB", (SELECT m FROM med)) AS "Size_KB" FROM valid""",
        "fill_constants": f"""WITH raw AS ({RAW_CATALOGUE_SQL})
            SELECT {_IDS},
                   COALESCE("Developer Website", 'Unknown') AS "Developer Website",
                   COALESCE("Privacy Policy", 'Unknown') AS "Privacy Policy",
                   COALESCE("Minimum Android", 'Varies with device') AS "Minimum Android"
            FROM raw""",
        "replace_sentinel": f"""WITH raw AS ({RAW_CATALOGUE_SQL})
            SELECT {_IDS}, CASE WHEN "Currency" IS NULL OR "Currency" = 'XXX' THEN 'USD' ELSE "Currency" END
                       AS "Currency"
            FROM raw""",
    }
)


# ------------------------------------------------------------ encoded features


def _index_cte(name: str, column: str, rows: str, fit: str) -> str:
    """Frequency index of a category over the fitted rows (ties by name)."""
    return f"""{name} AS (
        SELECT v, ROW_NUMBER() OVER (ORDER BY n DESC, v) - 1 AS i
        FROM (SELECT {_q(column)} AS v, COUNT(*) AS n FROM {rows} WHERE {_q(column)} IS NOT NULL AND {fit} GROUP BY 1))"""


def _encoded(rows: str, numeric: dict[str, str], fit: str) -> str:
    """CTEs up to ``encoded``: indexes, one-hots, numeric and scaled arrays, ``features``.

    ``numeric`` maps names to expressions over ``rows``; ``fit`` picks the rows
    that fix categories and ranges.  Missing numbers are NaN and stay out of
    the ranges; a column with one value becomes 0.5; a missing or unseen
    category gets the index after the last one.
    """
    cols = [f"x{i}" for i in range(len(numeric))]
    values = ", ".join(f"COALESCE(CAST({e} AS DOUBLE), 'NaN'::DOUBLE) AS {c}" for c, e in zip(cols, numeric.values(), strict=True))
    ranges = ", ".join(f"MIN({c}) FILTER (NOT isnan({c})) AS lo_{c}, MAX({c}) FILTER (NOT isnan({c})) AS hi_{c}" for c in cols)
    scaled = ", ".join(
        f"CASE WHEN isnan({c}) THEN {c} WHEN hi_{c} = lo_{c} THEN 0.5::DOUBLE ELSE ({c} - lo_{c}) * (1.0::DOUBLE / (hi_{c} - lo_{c})) END"
        for c in cols
    )
    hot = "list_transform(range({k} + 1), lambda j: CASE WHEN j = {i} THEN 1.0 ELSE 0.0 END)::DOUBLE[]"
    return f"""
        {_index_cte("cat", "Category", rows, fit)},
        {_index_cte("con", "Content Rating", rows, fit)},
        num AS (SELECT *, {values} FROM {rows}),
        span AS (SELECT {ranges} FROM num WHERE {fit}),
        size AS (SELECT (SELECT COUNT(*) FROM cat) AS kc, (SELECT COUNT(*) FROM con) AS kr),
        placed AS (
            SELECT num.*, COALESCE(cat.i, kc) AS ci, COALESCE(con.i, kr) AS ri, kc, kr,
                   [{", ".join(cols)}]::DOUBLE[] AS numeric_features,
                   [{scaled}]::DOUBLE[] AS numeric_features_scaled
            FROM num, span, size
            LEFT JOIN cat ON cat.v = num."Category" LEFT JOIN con ON con.v = num."Content Rating"),
        hot AS (
            SELECT *, CAST(ci AS DOUBLE) AS category_index, CAST(ri AS DOUBLE) AS content_rating_index,
                   {hot.format(k="kc", i="ci")} AS category_ohe, {hot.format(k="kr", i="ri")} AS content_rating_ohe
            FROM placed),
        encoded AS (
            SELECT *, list_concat(list_concat(numeric_features_scaled, category_ohe), content_rating_ohe) AS features FROM hot)"""


_ON_TRAIN = "split = 'train'"
_ML_BASE_CTE = f"""{FEATURES_CTE.replace(f"EXCLUDE ({_DROP})", "EXCLUDE (" + _DROP.replace('"App Id", ', "").replace(', "App Id"', "") + ")")},
base AS (
    SELECT *, CAST("Maximum Installs" AS DOUBLE) AS label,
           CASE WHEN COALESCE(CAST('0x' || substr(md5('0:' || "App Id"), 1, 4) AS BIGINT) / 65536.0, 0) < 0.7
                THEN 'train' ELSE 'test' END AS split
    FROM feat
    WHERE "Maximum Installs" IS NOT NULL AND "Category" IS NOT NULL AND "Content Rating" IS NOT NULL)"""
_ML_NUMBERS = [f"CAST({_q(c)} AS DOUBLE)" for c in fixed.ML_NUMERIC]
_ML_MEDIANS = ", ".join(
    f"quantile_disc({v}, 0.5) FILTER (WHERE {v} IS NOT NULL AND NOT isnan({v})) AS m{i}" for i, v in enumerate(_ML_NUMBERS)
)
_ML_FILLED = {
    c: f"CASE WHEN {v} IS NULL OR isnan({v}) THEN (SELECT m{i} FROM medians) ELSE {v} END"
    for i, (c, v) in enumerate(zip(fixed.ML_NUMERIC, _ML_NUMBERS, strict=True))
}

CATALOGUE_ORACLE.update(
    {
        "build_features": f"""WITH {FEATURES_CTE},
            {_encoded("feat", {c: _q(c) for c in fixed.ANALYSIS_NUMERIC}, "true")}
            SELECT {", ".join(map(_q, fixed.TRANSFORMED_COLUMNS))} FROM encoded""",
        "prepare_ml": f"""WITH {_ML_BASE_CTE},
            medians AS (SELECT {_ML_MEDIANS} FROM base WHERE {_ON_TRAIN}),
            {_encoded("base", _ML_FILLED, _ON_TRAIN)}
            SELECT {", ".join(map(_q, fixed.ML_PREPARED_COLUMNS))}, split FROM encoded""",
        "ml_baseline": f"""WITH {_ML_BASE_CTE},
            guess AS (SELECT AVG(label) AS m FROM base WHERE {_ON_TRAIN}),
            held AS (SELECT label, AVG(label) OVER () AS own FROM base WHERE NOT {_ON_TRAIN})
            SELECT ROUND(ANY_VALUE(m), 3) AS baseline_prediction, COUNT(*) AS n,
                   ROUND(SQRT(AVG((label - m) ** 2)), 3) AS rmse, ROUND(AVG(ABS(label - m)), 3) AS mae,
                   ROUND(1 - SUM((label - m) ** 2) / SUM((label - own) ** 2), 3) + 0.0::DOUBLE AS r2
            FROM held, guess""",
    }
)


# ------------------------------------------------ the nine questions on the features

_COMPLETE = 'SELECT * FROM feat WHERE "Category" IS NOT NULL AND "Rating" IS NOT NULL AND NOT isnan("Rating") AND "Maximum Installs" IS NOT NULL'

CATALOGUE_ORACLE.update(
    {
        "catalogue_top_by_mean": f"""WITH {FEATURES_CTE}
            SELECT "Category", count(*) AS total_apps, round(avg("Maximum Installs"), 0) AS avg_installs
            FROM feat GROUP BY ALL ORDER BY avg_installs DESC NULLS LAST, "Category" NULLS LAST LIMIT 10""",
        "catalogue_mean_by_level": f"""WITH {FEATURES_CTE}
            SELECT round("Rating") AS rating_level, count(*) AS total_apps, round(avg("Maximum Installs"), 0) AS avg_installs
            FROM feat WHERE "Rating" IS NOT NULL GROUP BY ALL""",
        "catalogue_top_min_size": f"""WITH {FEATURES_CTE}
            SELECT "Size_KB", count("Rating") AS app_count, round(avg("Rating"), 2) AS avg_rating
            FROM feat GROUP BY ALL HAVING app_count >= 100
            ORDER BY avg_rating DESC, app_count DESC, "Size_KB" NULLS LAST LIMIT 10""",
        "catalogue_mean_by_flag": f"""WITH {FEATURES_CTE}
            SELECT if(coalesce("Price", 1) = 0, 'Free', 'Paid') AS app_type, count(*) AS total_apps,
                   round(avg("Maximum Installs"), 2) AS avg_installs
            FROM feat GROUP BY ALL""",
        "catalogue_mean_by_band": f"""WITH {FEATURES_CTE}
            SELECT band.label AS app_age_group, count(*) AS total_apps, round(avg("Maximum Installs"), 0) AS avg_installs
            FROM feat ASOF JOIN (VALUES (-1000000, 'Less than 1 year'), (365, '1 to 3 years'),
                                        (1095, '3 to 5 years'), (1825, 'More than 5 years')) band(low, label)
                 ON feat.app_age_days >= band.low
            GROUP BY band.label""",
        "catalogue_best_subgroup": f"""WITH {FEATURES_CTE},
            pair AS (
                SELECT "Category", "Content Rating", count(*) AS total_apps, round(avg("Maximum Installs"), 0) AS avg_installs
                FROM feat WHERE "Content Rating" IS NOT NULL GROUP BY ALL)
            SELECT * FROM pair
            QUALIFY row_number() OVER (PARTITION BY "Category" ORDER BY avg_installs DESC NULLS LAST, "Content Rating") = 1
            ORDER BY avg_installs DESC NULLS LAST, "Category" NULLS LAST LIMIT 15""",
        "catalogue_summary": f"""WITH {FEATURES_CTE}
            SELECT count(*) AS total_apps, count(DISTINCT "Category") AS distinct_categories,
                   round(avg("Price"), 2) AS avg_price, round(var_samp("Price"), 2) AS price_variance,
                   round(avg("Rating Count"), 2) AS avg_installs, round(var_samp("Rating Count"), 2) AS installs_variance,
                   quantile_disc("Price", 0.5) AS median_price, quantile_disc("Rating Count", 0.25) AS installs_p25,
                   quantile_disc("Rating Count", 0.5) AS median_installs, quantile_disc("Rating Count", 0.75) AS installs_p75
            FROM feat WHERE "Price" IS NOT NULL AND "Rating Count" IS NOT NULL""",
        "catalogue_top_by_total": f"""WITH {FEATURES_CTE},
            total AS (
                SELECT "Category", CAST(sum("Maximum Installs") AS BIGINT) AS total_installs FROM ({_COMPLETE}) GROUP BY ALL)
            SELECT CAST(row_number() OVER (ORDER BY total_installs DESC, "Category") AS INTEGER) AS position, *
            FROM total QUALIFY position <= 10""",
        "catalogue_rating_buckets": f"""WITH {FEATURES_CTE}
            SELECT least(floor("Rating"), 4)::INT || '-' || (least(floor("Rating"), 4)::INT + 1) AS bucket,
                   count(*) AS app_count, round(avg("Maximum Installs"), 2) AS avg_installs
            FROM ({_COMPLETE}) WHERE "Rating" BETWEEN 0 AND 5 GROUP BY ALL""",
    }
)


# ------------------------------------------------ approximate forms keep to their bound

CATALOGUE_ORACLE.update(
    {
        "approx_quantiles": f"WITH {CLEANED_CTE} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", p, COUNT(*) AS n, true AS within FROM cleaned, (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) t(p) "
            f"WHERE {_q(c)} IS NOT NULL AND NOT isnan(CAST({_q(c)} AS DOUBLE)) GROUP BY p"
            for c in fixed.OUTLIER_COLUMNS
        ),
        "approx_summary": """
            SELECT t."column", t.p, COUNT(*) AS n, true AS within
            FROM lineitem, (VALUES ('l_tax', 0.5::DOUBLE), ('l_extendedprice', 0.25::DOUBLE),
                                   ('l_extendedprice', 0.5::DOUBLE), ('l_extendedprice', 0.75::DOUBLE)) t("column", p)
            WHERE if(t."column" = 'l_tax', l_tax, l_extendedprice) IS NOT NULL
            GROUP BY ALL""",
    }
)


# ------------------------------------------------ best single split and its leaf means

CATALOGUE_ORACLE["forest_stump"] = """
    WITH level AS (
        SELECT l_linenumber AS x, COUNT(*) AS n, SUM(CAST(l_quantity AS DOUBLE)) AS s FROM lineitem GROUP BY 1),
    side AS (
        SELECT t.x AS t, level.x <= t.x AS low, SUM(level.n) AS n, SUM(level.s) AS s FROM level, level t GROUP BY 1, 2),
    best AS (SELECT t FROM side GROUP BY t HAVING COUNT(*) = 2 ORDER BY SUM(s * s / n) DESC LIMIT 1)
    SELECT level.x AS l_linenumber, ROUND(side.s / side.n, 6) AS prediction, level.n
    FROM level, best JOIN side USING (t) WHERE side.low = (level.x <= best.t)"""


# ------------------------------------------------ the older form of the features

CATALOGUE_ORACLE["build_features_early"] = f"""WITH {FEATURES_CTE},
    {_encoded("feat", {c: _q(c) for c in fixed.EARLY_NUMERIC}, "true")}
    SELECT {", ".join(map(_q, fixed.TRANSFORMED_COLUMNS))} FROM encoded"""
