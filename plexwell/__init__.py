"""Plate-based transcriptomics analytics as Spark DataFrame operators."""
