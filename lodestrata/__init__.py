"""lodestrata: a Spark-native engine that cleans, types and publishes semi-structured listings."""
