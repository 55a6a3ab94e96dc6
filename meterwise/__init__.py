"""meterwise: data quality, star model and KPIs for trip records, on Spark."""
