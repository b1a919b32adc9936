"""A raw-text catalogue derived by Spark from the driver's tables.

Each line item becomes one catalogue row whose 24 columns are *text*, in the
forms the cleaning job must parse: counts with ``+`` and thousands commas,
``$`` prices, sizes in ``M`` / ``k`` / other units, ``MMM d, yyyy`` dates,
loosely written flags, sentinel currencies, and missing identifiers, categories,
ratings and prices.  The
order's date is the release day and the ship date the update day, so the
date-order rule has real violations; several lines share an order, so the id
has duplicates.  The work grows with ``lineitem``.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalytics.sources.io import read_table

S = F.col
#: Line items of one partition of the join: few enough to sort in memory whatever the input.
JOIN_ROWS = 250_000


def _str(c):
    return c.cast("string")


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    # The text that the row rules compare is made once a row, below the join: made above
    # it, the filters on top would each make it again, several times a row.
    li = li.withColumns(
        {
            "Minimum Installs": F.format_number(S("l_extendedprice").cast("long"), 0),
            "Last Updated": F.date_format(S("l_shipdate"), "MMM d, yyyy"),
        }
    )
    orders = orders.select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.concat(F.format_number(S("o_totalprice").cast("long"), 0), F.lit("+")).alias("Installs"),
        F.date_format(S("o_orderdate"), "MMM d, yyyy").alias("Released"),
    )
    # Equi-join on the order key.  Beyond one partition's rows (counted from the Parquet
    # footers) both sides are dealt into partitions that grow in number, not in size, so
    # their sorts don't spill; a small input is left to Spark's own choice.
    n = ceil(li.count() / JOIN_ROWS)
    if n > 1:
        li, orders = li.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey").hint("merge")
    j = li.join(orders, S("l_orderkey") == S("o_orderkey"))
    ln = S("l_linenumber")
    size = (
        F.when(ln == 1, F.concat(_str(S("l_quantity").cast("int")), F.lit("M")))
        .when(ln == 2, F.concat(F.format_number(S("l_partkey"), 0), F.lit("k")))
        .when(ln == 3, F.lit("Varies with device"))
        .when(ln == 4, F.lit("0"))
        .when(ln == 5, F.lit("1.1G"))
        .when(ln == 6, F.concat(_str(S("l_quantity")), F.lit("M")))
        .otherwise(F.concat(_str(S("l_suppkey")), F.lit("k")))
    )
    cols = {
        "App Name": F.concat(F.lit("item "), _str(S("l_orderkey")), F.lit("-"), _str(ln)),
        "App Id": _str(S("l_orderkey")),
        "Category": F.when((ln != 6) | (S("l_returnflag") != "A"), S("o_orderpriority")),
        "Rating": F.when(S("l_quantity") < 49, _str(F.round(S("l_discount") * 50, 1))),
        "Rating Count": _str(S("l_quantity")),
        "Installs": S("Installs"),
        "Minimum Installs": S("Minimum Installs"),
        "Maximum Installs": _str((S("l_extendedprice") * (1 + S("l_tax")) * 10).cast("long")),
        "Free": F.lit("True"),
        "Price": F.when(S("l_tax") == 0, F.lit("0")).when(
            S("l_quantity") != 25, F.concat(F.lit("$"), _str(S("l_tax")))
        ),
        "Currency": F.when(S("l_returnflag") == "R", F.lit("XXX")).when(
            S("l_returnflag") != "A", F.lit("USD")
        ),
        "Size": size,
        "Minimum Android": F.when(S("l_linestatus") == "O", F.lit("4.0.3 and up")).when(
            S("l_returnflag") == "R", F.concat(_str(ln), F.lit(".1 and up"))
        ),
        "Developer Id": F.concat(F.lit("dev"), _str(S("l_suppkey"))),
        "Developer Website": F.when(
            S("l_returnflag") != "N", F.concat(F.lit("https://d"), _str(S("l_suppkey")))
        ),
        "Developer Email": F.when(
            ln != 7, F.concat(F.lit("dev"), _str(S("l_suppkey")), F.lit("@x.com"))
        ),
        "Released": S("Released"),
        "Last Updated": S("Last Updated"),
        "Content Rating": S("o_orderstatus"),
        "Privacy Policy": F.when(S("l_linestatus") != "F", F.lit("https://p")),
        "Ad Supported": F.when(S("l_returnflag") == "N", F.lit("True"))
        .when(S("l_returnflag") == "R", F.lit(" TRUE "))
        .otherwise(F.lit("maybe")),
        "In App Purchases": F.when(S("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("False")),
        "Editors Choice": F.when(S("l_discount") >= 0.09, F.lit("True")).otherwise(F.lit("False")),
        "Scraped Time": F.date_format(S("l_shipdate"), "yyyy-MM-dd HH:mm:ss"),
    }
    return j.select(*[c.alias(name) for name, c in cols.items()])


# DuckDB form of the same derivation, for the oracle SQL.
RAW_CATALOGUE_SQL = """
    SELECT
        'item ' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "App Name",
        CAST(l_orderkey AS VARCHAR) AS "App Id",
        CASE WHEN l_linenumber <> 6 OR l_returnflag <> 'A' THEN o_orderpriority END AS "Category",
        CASE WHEN l_quantity < 49 THEN CAST(ROUND(l_discount * 50, 1) AS VARCHAR) END AS "Rating",
        CAST(l_quantity AS VARCHAR) AS "Rating Count",
        format('{:,}', CAST(trunc(o_totalprice) AS BIGINT)) || '+' AS "Installs",
        format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT)) AS "Minimum Installs",
        CAST(CAST(trunc(l_extendedprice * (1 + l_tax) * 10) AS BIGINT) AS VARCHAR) AS "Maximum Installs",
        'True' AS "Free",
        CASE WHEN l_tax = 0 THEN '0' WHEN l_quantity <> 25 THEN '$' || CAST(l_tax AS VARCHAR) END AS "Price",
        CASE WHEN l_returnflag = 'R' THEN 'XXX' WHEN l_returnflag <> 'A' THEN 'USD' END AS "Currency",
        CASE l_linenumber
            WHEN 1 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || 'M'
            WHEN 2 THEN format('{:,}', l_partkey) || 'k'
            WHEN 3 THEN 'Varies with device'
            WHEN 4 THEN '0'
            WHEN 5 THEN '1.1G'
            WHEN 6 THEN CAST(l_quantity AS VARCHAR) || 'M'
            ELSE CAST(l_suppkey AS VARCHAR) || 'k'
        END AS "Size",
        CASE WHEN l_linestatus = 'O' THEN '4.0.3 and up'
             WHEN l_returnflag = 'R' THEN CAST(l_linenumber AS VARCHAR) || '.1 and up' END
            AS "Minimum Android",
        'dev' || CAST(l_suppkey AS VARCHAR) AS "Developer Id",
        CASE WHEN l_returnflag <> 'N' THEN 'https://d' || CAST(l_suppkey AS VARCHAR) END
            AS "Developer Website",
        CASE WHEN l_linenumber <> 7 THEN 'dev' || CAST(l_suppkey AS VARCHAR) || '@x.com' END
            AS "Developer Email",
        strftime(o_orderdate, '%b %-d, %Y') AS "Released",
        strftime(l_shipdate, '%b %-d, %Y') AS "Last Updated",
        o_orderstatus AS "Content Rating",
        CASE WHEN l_linestatus <> 'F' THEN 'https://p' END AS "Privacy Policy",
        CASE WHEN l_returnflag = 'N' THEN 'True' WHEN l_returnflag = 'R' THEN ' TRUE ' ELSE 'maybe' END
            AS "Ad Supported",
        CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'False' END AS "In App Purchases",
        CASE WHEN l_discount >= 0.09 THEN 'True' ELSE 'False' END AS "Editors Choice",
        strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "Scraped Time"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
