"""DataFrame operators: cleaning, typed projection, conform/union/enrich, de-duplication,
keys, checks, snapshot merge and staged/versioned sinks."""
