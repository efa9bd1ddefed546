"""leadlens: a Spark-native operator library for campaign targeting.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, aggregates and windows, so Catalyst plans it and whole-stage
codegen runs it.  Sub-packages:

* ``sources``   readers, sinks, model persistence, synthetic customers
* ``functions`` column-expression builders (bins, verdicts, sentinels, ...)
* ``operators`` profile, clean, split, features, train, evaluate, leads
* ``plans``     derived datasets over the driver tables and the query catalog
* ``streaming`` micro-batch scoring of arriving customer files
"""

__version__ = "0.1.0"
