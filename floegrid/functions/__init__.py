"""Column functions: names, radiometry, field clean-up, vectors, projection, geometry, grids."""
