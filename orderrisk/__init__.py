"""Order-fraud scoring, evaluation and explanation as Spark DataFrame jobs."""
