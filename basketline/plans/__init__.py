"""Table builders, reports, checks and the pipeline."""
