"""DataFrame operators: spatial joins, neighbour graphs, composition, ranks, gating, rasters, drift."""
