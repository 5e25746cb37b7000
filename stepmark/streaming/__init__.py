from stepmark.streaming.jsonl import stream_jsonl, stream_peek, stream_prepare, stream_regroup

__all__ = ["stream_jsonl", "stream_peek", "stream_prepare", "stream_regroup"]
