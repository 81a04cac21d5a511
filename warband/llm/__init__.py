"""Training-data operators: tokenizers, extraction, deduplication, classifiers, decontamination."""
