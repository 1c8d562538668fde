"""Registered queries of the reference's operators, each with SQL where SQL can express it."""

from . import chat, corpus, curate, models, observe, replies, score, web
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "chat", "corpus", "curate", "models", "observe", "replies", "score", "web"]
