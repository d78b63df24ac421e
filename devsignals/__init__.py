"""Developer-activity analytics on Spark: bronze, silver and gold datasets,
quality checks, reports and streams over code-hosting events and news stories."""
