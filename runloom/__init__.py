"""Sequencing-run analytics as Spark DataFrame operators."""
