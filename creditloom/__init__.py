"""Table operators for Spark: data quality, version history, cleaning and risk scores.

Sub-packages:

* ``functions``  column expressions (checks, ladders, text parsing, hashing)
* ``operators``  DataFrame-to-DataFrame operators built on those expressions
* ``sources``    reading, writing and staging of tables
* ``plans``      shipped rules, whole-table jobs and the query catalogue
* ``streaming``  micro-batch use of the same operators
"""
