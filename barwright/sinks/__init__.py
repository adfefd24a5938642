"""Writers of raw landings and partitioned tables, and their catalog entries."""
