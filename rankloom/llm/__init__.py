"""Operators for preparing training corpora; nothing else in rankloom imports them."""
