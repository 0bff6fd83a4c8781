"""scanloom: Spark jobs for preparing and analysing multi-sensor recordings."""
