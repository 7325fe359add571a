"""Column functions: text, geometry and scores."""
