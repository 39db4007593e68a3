"""Wiki dump extraction and link analytics as Spark DataFrame programs."""
