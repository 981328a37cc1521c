"""Layered (bronze, silver, gold) vehicle-fleet analytics as PySpark DataFrame operators."""
