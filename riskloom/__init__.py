"""Spark-native credit-risk feature building, model evaluation and scoring."""
