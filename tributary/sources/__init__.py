"""Sources: action-log and change-event topics (Kafka or files), routing rules, dimensions,
and the adapters that derive all inputs from the provided test tables."""
