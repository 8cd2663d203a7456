"""quayside.sources."""
