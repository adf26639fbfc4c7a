"""Operators that prepare training data: ten corpus operators and their queries."""
