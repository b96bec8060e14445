"""Ad-click analytics as Spark jobs: ingest, windows, marts, quality, faults."""
