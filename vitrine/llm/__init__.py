"""Operators of a training-data pipeline: mixing, decontamination, quality, licences, duplicates, toxicity,
token output and language, each over whole tables."""
