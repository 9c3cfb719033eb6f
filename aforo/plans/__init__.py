"""Query plans: dimensions, facts, extracts, control state and loads."""
