"""Sources and sinks: raw notification files, derived test input, warehouse tables."""
