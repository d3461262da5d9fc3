"""Landed feed pages, review tables and the keyed topic-result store."""
