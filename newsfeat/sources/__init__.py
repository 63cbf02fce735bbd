"""Sources and sinks (S1-S12) and the driver-table loaders."""
