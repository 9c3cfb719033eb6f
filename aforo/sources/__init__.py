"""Archives, staging rows and the calendar of expected archives."""
