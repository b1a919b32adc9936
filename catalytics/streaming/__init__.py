"""The cleaning plan over a stream of raw text files.

The source project is batch-only; these helpers only show that its row-level
operators are plain Column expressions and therefore run unchanged in
Structured Streaming.  Typing, rules, size parsing, constant fills and the
identifier filter are per row; the size median is a global statistic, so it
is passed in (for example from a batch run over history) rather than
recomputed per micro-batch.
"""

from catalytics.streaming.cleaning import clean_stream, rule_counts_stream, start_parquet_sink

__all__ = ["clean_stream", "rule_counts_stream", "start_parquet_sink"]
