"""The three jobs of the engine: load, coverage report, export."""
