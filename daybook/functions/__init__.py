"""Column-level helpers: label presets and maps, zone-explicit dates, report metrics."""
