"""Sources (scans) and sinks (partitioned table writes)."""
