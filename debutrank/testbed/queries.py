"""All queries and their SQL statements."""

from debutrank.testbed import nested, relations, scans, scores, states

QUERIES = {}
ORACLE = {}
for _module in (scores, relations, scans, nested, states):
    QUERIES.update(_module.R.queries)
    ORACLE.update(_module.R.sql)
