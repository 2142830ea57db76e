"""Insurance-portfolio analytics as Spark DataFrame jobs."""
