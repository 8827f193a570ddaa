"""Reading and writing: files, cell grids, state tables."""
