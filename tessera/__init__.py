"""Tessera: entity-knowledge analytics as composable PySpark DataFrame operators."""
