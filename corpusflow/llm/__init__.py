"""Operators of a training-data pipeline: dedup, search, quality, secrets,
mixing, decontamination, licences, token counts and web archives."""
