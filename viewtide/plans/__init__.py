"""Reports, data quality checks and the whole pipeline."""
