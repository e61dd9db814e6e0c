"""flowmart: yearly flow statistics as Spark DataFrame operators and mart jobs."""
