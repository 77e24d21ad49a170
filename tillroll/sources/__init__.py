"""Sources (readers, driver-table views) and sinks."""
