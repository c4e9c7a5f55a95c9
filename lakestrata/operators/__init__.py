"""DataFrame -> DataFrame operators for each layer."""
