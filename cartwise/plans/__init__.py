"""Query catalogue, oracle SQL and the compare tool."""
