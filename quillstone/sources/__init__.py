"""Sources and sinks: price files, reference files and the versioned snapshot table."""
