"""quern: analytics tables, history, data checks and streams as plain PySpark functions."""
