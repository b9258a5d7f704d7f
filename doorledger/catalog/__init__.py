"""Registered queries over the driver tables, each with SQL that states the same result.

A module lists ``QUERIES``: name -> (callable(spark, sf_dir), SQL text or None).
"""
