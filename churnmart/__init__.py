"""Customer-churn warehousing as Spark DataFrame jobs."""
