"""Column-level building blocks: series indexing, halo blocks, affine scans, scalars."""
