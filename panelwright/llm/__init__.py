"""Operators for building training data: counting, extracting, filtering, scoring and mixing texts and pages."""
