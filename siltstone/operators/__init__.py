"""Operators on whole tables. All are lazy; none collects rows."""
