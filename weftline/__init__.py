"""Weftline: data operators for Spark, each a plain ``DataFrame -> DataFrame`` function."""
