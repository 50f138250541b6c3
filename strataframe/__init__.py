"""strataframe: a Spark-native engine for spatial batch analytics and corpus preparation."""
