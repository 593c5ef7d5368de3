from tickloom.streaming.feeds import (
    stream_batch_layer,
    stream_lines,
    stream_topic,
    stream_warehouse,
)

__all__ = ["stream_batch_layer", "stream_lines", "stream_topic", "stream_warehouse"]
