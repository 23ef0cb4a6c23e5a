"""loomgraph: a Spark-native knowledge retrieval and composition engine."""
