"""Operators for training data: one module per operator, registered in `queries`."""
