"""Sources and sinks: CSV files, the Parquet table store, driver-table bindings."""
