"""A PySpark engine for the quality, alignment and concordance of versioned text corpora."""
