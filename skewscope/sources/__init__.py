"""Sources: batch scans, cleaning, and the test tables."""
