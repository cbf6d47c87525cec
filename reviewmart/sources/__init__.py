"""Readers: CSV files, dataset folders, web pages and the warehouse."""
