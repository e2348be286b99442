"""Operators that turn raw web text into training data at cluster scale."""
