"""Shipment event analytics expressed as Spark DataFrames and streams."""
