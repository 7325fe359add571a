"""PySpark library for real-estate listings and the places around them."""
