"""Text cleaning, topic modelling and topic evaluation as Spark DataFrame jobs."""
