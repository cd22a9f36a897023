"""Batch scoring (M8) applied to a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame


def score_stream(model, stream: DataFrame, keep=None) -> DataFrame:
    """``model.transform`` on a streaming frame.  Every stage of the text
    pipeline and of the vector models is a per-row projection, so the plan
    is stateless: no watermark is needed and each micro-batch is scored
    independently (exactly-once with a replayable source and an idempotent
    or transactional sink)."""
    if not stream.isStreaming:
        raise ValueError("score_stream expects a streaming DataFrame")
    out = model.transform(stream)
    return out.select(*keep, "prediction") if keep else out
