"""Spark-native spare-parts demand planning.

Sub-packages:

* ``functions``  column expressions: month windows, safe division, fixed lookups
* ``sources``    table/CSV readers, table writers, and the test-data binding
* ``operators``  DataFrame-in/DataFrame-out domain operators
* ``plans``      end-to-end jobs and the registry of named queries

Every operator takes an explicit ``as_of`` date instead of reading the clock.
"""

__version__ = "0.1.0"
