"""Operators for preparing training corpora (near duplicates, mixing, secrets,
fingerprints, language, decontamination, licences, line repeats, quality, personal
data). Nothing outside this package imports it."""
