"""Dimensions, facts, marts, explorations and the warehouse load."""
