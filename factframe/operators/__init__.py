"""Relational operators over clips, frames, sentences and facts."""
