"""Part of the extract engine."""
