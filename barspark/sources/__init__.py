"""Sources and sinks: driver tables, bar files, the warehouse."""
