"""Spark-native operators for curating large driving-perception datasets."""
