"""Operators for preparing training data at scale; see the registry for their queries."""
