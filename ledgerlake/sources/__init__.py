"""Sources: the manifest (A1), archive scans (B1-B9, A11), lookup JSON (E1),
the archive writer and the fixture views over the driver tables."""
