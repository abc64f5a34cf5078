"""DataFrame -> DataFrame operators: relational, pivots, statistics, text,
event-time windows, feature preparation and models."""
