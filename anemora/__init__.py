"""anemora: extreme-weather signals and large-table data preparation on Spark."""
