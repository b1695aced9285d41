"""Sources: table scans, the behaviour CSV, line streams, owned partitions, replay."""
