"""Plans: the marts, dashboard aggregates, the yearly job and the query registry."""
