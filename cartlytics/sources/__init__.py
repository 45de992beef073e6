"""Sources and sinks: declared schemas, typed CSV/Parquet load, export,
catalog registration, previews and row counts, and the mapping of the
driver's test tables onto the six product-analytics roles."""
