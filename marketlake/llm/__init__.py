"""Training-data operators: cleaning, near-dedup, decontamination, mixing, archives.

Nothing else in the library imports this subpackage.
"""
