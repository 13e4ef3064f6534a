"""larkspur: Spark-native event ingestion, lake analytics and lake maintenance."""
