"""Sources and sinks: typed scans, SQL templates with bound parameters, fixture tables, writers."""
