"""DataFrame operators: dates, overlap, mosaic, pyramid, warp, cube, catalogue, tiles."""
