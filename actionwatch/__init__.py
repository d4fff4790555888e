"""actionwatch: Spark-native event tracking over many overlapping reports."""
