"""Operators for preparing training data: token counts, dedup, scans, language, quality, archives and decontamination."""
