"""Composed plans: silver cleaning, gold features and labels, reports, backfill."""
