"""The registered queries and the SQL that computes the same rows another way."""
