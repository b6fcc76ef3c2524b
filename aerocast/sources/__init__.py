"""Sources: the observation adapter over the driver tables, CSV history,
landed JSON payloads, stored history and model records."""
