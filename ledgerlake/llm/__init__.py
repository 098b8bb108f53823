"""Training-data operators: filtering, deduplication, decontamination, packing.

Nothing else in ``ledgerlake`` imports this subpackage.  Each module holds one
operator; ``queries`` registers the digests that the build driver compares.
"""
