"""Demand-panel analytics on Spark: lazy DataFrame operators over daily (date, store, item, sales) tables."""
