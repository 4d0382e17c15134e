"""Part of tarnlake."""
