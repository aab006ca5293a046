"""Training-data operators: extraction, scoring, de-duplication, decontamination, tokenisation."""
