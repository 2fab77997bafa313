"""Relational operators: cleaning, affinity, numbering, sampling, scoring, metrics, replay, rerank, factors."""
