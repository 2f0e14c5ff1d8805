"""heliograph: a Spark-native research-expertise and corpus analytics engine."""
