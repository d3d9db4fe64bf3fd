"""Sources and sinks: config-described reads and writes, inventories, generators."""
