"""dimwright: dimensional ETL, data cleaning and grouped analytics on Spark.

Sub-packages:

* ``sources``   - readers for the input tables and the source views built over them
* ``functions`` - column expressions with the reference's SQL semantics (rounding,
                  case-insensitive text, calendar attributes, decimal measures)
* ``operators`` - reusable DataFrame operators: bounded broadcast, as-of join,
                  surrogate keys, SCD1/SCD2, upsert, snapshot publish, quality checks
* ``plans``     - the jobs: listing cleaning and questions, extracts, fact build,
                  daily mart run, and the query registry with its SQL oracles
* ``streaming`` - intentionally empty (the reference has no streaming work)
"""

__all__ = ["session"]
