"""A Spark-native engine that turns messy, multi-source event and document data into a clean catalogue."""
