"""Column functions: geometry, rasters, names and arrays."""
