"""Operators for preparing training data: cleaning, duplicate removal, scoring, encoding and packing of documents."""
