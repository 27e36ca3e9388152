"""pairloom: a Spark-native engine for paired image, sequence and text datasets."""
