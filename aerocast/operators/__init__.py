"""DataFrame operators: contract checks, features, store, joins, models."""
