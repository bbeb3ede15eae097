"""Evidence-fusion and corpus-processing operators for Spark."""
