"""starbeam: a Spark-native retail star-schema warehouse and its business queries."""
