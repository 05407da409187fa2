"""Operators for preparing training data: tokenizing, scoring, cleaning and filtering of text."""
