"""Structured Streaming: scoring a stream with a fitted model.

The original jobs are batch only.  A fitted text pipeline is row-wise from
tokenizer to naive Bayes, so the same model scores a stream unchanged;
that is the only streaming piece here (no stateful operator).
"""

from .scoring import score_stream  # noqa: F401
