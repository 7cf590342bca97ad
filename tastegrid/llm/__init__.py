"""Operators for training-data pipelines: sharding, similarity, tokens, mixing, classifiers, archives, decontamination."""
