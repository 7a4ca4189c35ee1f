"""Frame-level building blocks shared by the report plans."""
