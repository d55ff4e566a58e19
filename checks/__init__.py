"""Queries over the test tables, one or more per operator, and the SQL each must agree with."""
