"""cartlytics: product-analytics operators for Spark.

Every operator takes DataFrames and returns a DataFrame, so it composes with
ordinary Spark code and runs on the cluster; nothing that grows with the data
is collected to the driver.

Entry points:

- ``cartlytics.sources.tables.load_tables_csv`` / ``load_tables_parquet``:
  the six tables under their declared schemas.
- ``cartlytics.reports.build_reports``: every report by name over them.
- ``cartlytics.operators.*``: the individual operators (revenue, cohorts,
  ranking, timeseries, funnel, experiment, sampling, quality).
- ``cartlytics.plans.global_rank.add_row_number``: distributed global
  ROW_NUMBER / RANK.
- ``cartlytics.session.configure``: the session settings the operators assume.
"""

__version__ = "0.1.0"
