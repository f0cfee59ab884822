"""Dashboard datasets as DataFrame plans, their checks and the catalog."""
