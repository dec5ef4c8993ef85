"""Operators for preparing training text: extraction, quality, chat, search, archives, secrets, packing, near duplicates."""
