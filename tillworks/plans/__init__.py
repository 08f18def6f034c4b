"""The reports and jobs."""
