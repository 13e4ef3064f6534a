"""Column functions: guarded casts, uuids, JSON text, partition transforms."""
