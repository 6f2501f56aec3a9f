"""DataFrame-to-DataFrame operators; nothing here runs a write."""
