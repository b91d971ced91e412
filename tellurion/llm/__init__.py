"""Training-data operators: decontamination, token output, near-duplicates, scoring, mixing, archives."""
