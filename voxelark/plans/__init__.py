"""Composed plans: step chains, feature extraction, registered queries."""
