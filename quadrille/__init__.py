"""Spark-native engine for collections of spatially located image volumes."""
