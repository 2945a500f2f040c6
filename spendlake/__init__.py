"""spendlake: public-spending analytics on Spark (clean, star schema, merges, quality, ML)."""
__version__ = "0.1.0"
