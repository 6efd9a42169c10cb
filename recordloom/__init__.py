"""recordloom: Spark-native curation of metadata records and their texts."""
