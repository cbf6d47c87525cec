"""End-to-end plans: ingestion, load, administration, dashboard."""
