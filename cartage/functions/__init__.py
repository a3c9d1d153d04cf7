"""Column-level building blocks: types, keys, paths and texts."""
