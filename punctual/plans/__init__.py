"""The datasets, gates, reports and jobs, composed from the operators."""
