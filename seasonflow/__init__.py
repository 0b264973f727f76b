"""seasonflow: weekly sell-out analytics expressed as lazy Spark DataFrame plans.

Layout
------
- ``sources``   readers, writers, temp-view helpers and the driver-table loaders
- ``functions`` Column-returning helpers (yearweek parsing, rounding, arrays, schemas)
- ``operators`` DataFrame -> DataFrame operators (cleaning, joins, group statistics,
                moving averages / seasonality, shares, reshaping, forecasting)
- ``plans``     the query catalogue (one callable per inventoried operator), the
                matching DuckDB oracle SQL, and plan-inspection helpers

Every operator takes and returns DataFrames or Columns; nothing creates a session,
registers global names, collects rows to the driver or uses a Python UDF.
"""

__version__ = "0.1.0"
