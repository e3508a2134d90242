"""Lodework: a sales lakehouse, its data products and a feature store as Spark jobs."""
