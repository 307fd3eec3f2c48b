"""Catalogue analytics on Spark: scans, normalisation, matching, merges, audits and queries."""
