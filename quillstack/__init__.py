"""Spark jobs that turn a scraped logbook archive into clean, linked tables."""
