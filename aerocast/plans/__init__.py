"""User entry points (backfill, training, forecast, collect) and the
registered query catalogue."""
