"""Plans: adapter views, the load scenario, batch jobs and the query catalog."""
