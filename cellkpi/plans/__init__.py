"""End-to-end jobs and the driver-table query catalogue."""
