"""The operators applied to the test tables, with the SQL that must agree."""
