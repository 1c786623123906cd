"""The jobs end to end: from a task row to written result tables."""
