"""Join strategies and end-to-end pipelines."""
