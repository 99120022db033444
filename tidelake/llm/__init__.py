"""Operators that prepare training data, with their queries; nothing outside imports them."""
