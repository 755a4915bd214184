"""DataFrame to DataFrame operators and the sinks they write to."""
