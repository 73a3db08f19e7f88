"""A Spark-native engine that turns raw documents and pages into chunks, checks and queries them."""
