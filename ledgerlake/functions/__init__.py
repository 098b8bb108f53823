"""Scalar functions as native Spark expressions: hex decoding."""
