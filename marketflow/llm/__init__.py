"""Operators for preparing training data: packing, language ID, dedup, licences, quality, chat, sharding."""
