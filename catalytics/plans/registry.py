"""All registered queries and their SQL."""

from catalytics.plans import bindings, oracle, oracle_stored, stored

QUERIES = bindings.QUERIES | stored.QUERIES
ORACLE_SQL = oracle.ORACLE_SQL | oracle_stored.STORED_ORACLE
