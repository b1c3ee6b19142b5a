"""Feature engineering, model evaluation and drift monitoring as Spark DataFrame operators."""
