"""Offer-data extraction, cleaning, loading and price analysis on Spark."""
