from payments_lake.streaming.stream_sample import silver_stream_sample, stream_sample

__all__ = ["silver_stream_sample", "stream_sample"]
