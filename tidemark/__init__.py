"""tidemark: Spark-native building blocks for lakehouses whose drops drift, repeat and get corrected."""
