"""quayside.functions."""
