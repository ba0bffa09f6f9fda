"""Part of leadflow."""
