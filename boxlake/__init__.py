"""boxlake: a PySpark batch warehouse for team-sports box scores."""
