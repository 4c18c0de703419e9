"""The operators applied to the test tables, each with an equivalent SQL statement."""
