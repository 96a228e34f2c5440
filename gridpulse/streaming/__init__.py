from gridpulse.streaming.dedup import dedup_stream
from gridpulse.streaming.runs import StreamRun, process_stream, write_stream

__all__ = ["StreamRun", "dedup_stream", "process_stream", "write_stream"]
