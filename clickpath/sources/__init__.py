"""Scans, decoders and the Parquet event lake."""
