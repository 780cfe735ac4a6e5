"""Finished datasets: gold tables, exploration reports, served views, pipeline."""
