"""The layers: bronze, silver, gold, dimensions, separation facts, reports, scoring, and their run."""
