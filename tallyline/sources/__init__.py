"""Files and stored tables: arrival checks, loading, versioned snapshots."""
