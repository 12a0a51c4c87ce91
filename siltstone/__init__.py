"""Layered monthly data marts on Spark: lenient typing, cleaning rules, quality
profiles, deterministic dedup, feature joins and loan-performance labels.

Everything is a lazy ``DataFrame -> DataFrame`` or ``Column -> Column`` function
made of built-in Spark expressions. Results do not depend on ANSI mode.
"""
