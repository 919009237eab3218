"""Operators over text corpora: language, near copies, leaks, personal data, tokens, chats, addresses, quality, toxicity."""
