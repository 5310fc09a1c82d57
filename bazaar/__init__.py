"""Retail analytics on Spark: raw marketplace tables to a star schema, marts, profiles and gates."""
