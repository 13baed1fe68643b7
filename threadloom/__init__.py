"""A PySpark-native engine for conversation and document corpora."""

from threadloom.engine import ConversationEngine

__all__ = ["ConversationEngine"]
