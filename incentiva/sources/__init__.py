"""Source schemas and loaders, test-data mapping, and report sinks."""
