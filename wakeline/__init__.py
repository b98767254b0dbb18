"""wakeline: trajectory-event analytics as Spark DataFrame jobs."""
