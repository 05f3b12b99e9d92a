"""Consensus annotation of similarity hits on Spark: DataFrame in, DataFrame out."""
