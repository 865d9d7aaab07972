"""millrace: feature engineering, models and text analytics as Spark DataFrame jobs."""
