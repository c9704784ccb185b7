"""Model jobs over the feature matrix."""
