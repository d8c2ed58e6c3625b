"""Training-data operators: counting, filtering, formatting, mixing, scanning and de-duplication of texts."""
