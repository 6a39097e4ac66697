"""Training-data pipeline operators (each module documents its method); nothing else in the library imports this package."""
