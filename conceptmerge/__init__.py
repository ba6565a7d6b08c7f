"""A Spark-native engine for building and maintaining a terminology knowledge base."""
