"""Training-data operators: tokenizing, filtering, de-duplication, decontamination."""
