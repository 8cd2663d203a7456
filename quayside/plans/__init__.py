"""quayside.plans."""
