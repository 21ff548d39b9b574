"""DataFrame -> DataFrame operators (and the MLlib stages they fit)."""
