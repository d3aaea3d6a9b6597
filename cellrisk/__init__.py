"""cellrisk: subscriber churn and spatial risk analytics as Spark jobs."""
