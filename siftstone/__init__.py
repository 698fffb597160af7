"""siftstone: a Spark-first engine for rule-based quality classification of large item collections."""
