"""giniflow: Spark-native toolkit for building and checking binary scoring models."""
