"""lumenfold: an analytics engine expressed in PySpark's DataFrame, SQL and streaming APIs."""
