"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this subpackage imports it. ``queries`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five of them.
"""
