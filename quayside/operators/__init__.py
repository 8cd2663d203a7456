"""quayside.operators."""
