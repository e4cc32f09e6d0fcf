"""Ready-made profiles: fixed values of known survey families."""
