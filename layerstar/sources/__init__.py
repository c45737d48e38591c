"""Sources and sinks: declared schemas, CSV reading, layer layout, publish, audit."""
