"""Operators of a training-data pipeline: tokens, languages, duplicates, leaks, pages, chats, vectors."""
