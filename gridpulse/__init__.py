"""Player-tracking analytics as Spark jobs: decode, clean, roll up, match, report and score."""
