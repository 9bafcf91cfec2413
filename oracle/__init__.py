"""Independent SQL for every registered query, to run on another engine."""
