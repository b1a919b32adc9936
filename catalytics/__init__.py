"""catalytics — catalogue analytics expressed as Spark DataFrame plans.

Every public operator takes and returns a lazy ``DataFrame``; column names are
parameters.  Sub-packages:

* ``sources``   — raw-text / Parquet scans, Parquet sinks, SQL over bound frames,
                  model persistence, lineage cuts into ``spark.checkpoint.dir``.
* ``functions`` — column-expression builders (parsing, dates, buckets).
* ``operators`` — DataFrame -> DataFrame operators (rules, missing values,
                  grouped statistics, top-k, exact quantiles, reports, features,
                  splits, models).
* ``plans``     — the named questions and the end-to-end jobs built from them,
                  plus the binding of those jobs to the test tables.
* ``streaming`` — the row-level cleaning plan applied to a file stream.
"""

__version__ = "0.1.0"
