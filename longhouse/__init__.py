"""Archive ingest, linkage and export of study data on Spark."""
