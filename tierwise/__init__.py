"""tierwise: layered (bronze -> silver -> gold) contract analytics on Spark.

Every operator is a function from DataFrame(s) to DataFrame built from
built-in ``pyspark.sql.functions`` so Catalyst can prune, push down and
code-generate the whole plan.  Sub-packages:

* ``sources``   - typed CSV readers/writers, test-table adapters
* ``functions`` - column helpers (strict/safe casts, guarded ratios, dates)
* ``operators`` - silver models, gold models, data-quality rules, monitoring
* ``plans``     - the registered queries, their oracle SQL, the layered run
* ``streaming`` - intentionally empty (the reference has no streams)
"""

__version__ = "0.1.0"
