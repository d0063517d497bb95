"""Layered lakehouse table operators for PySpark.

* ``sources``    scans, landing, sinks and the catalog: the only code that touches paths
* ``functions``  column expressions and projections (no shuffle)
* ``operators``  DataFrame -> DataFrame: filters, dedup, keys, merges, dimensions, metadata
* ``plans``      layer updates that read, transform and write (bronze, silver, gold)
* ``queries``    the registered queries with the SQL that checks them
"""
