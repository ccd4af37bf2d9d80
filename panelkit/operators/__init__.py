"""DataFrame -> DataFrame operators. No collect, no driver loops over entities."""
