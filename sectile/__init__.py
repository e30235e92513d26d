"""sectile: Spark-native analytics for tiled slice stacks and large tables."""
