from loadsmith.streaming.incremental import stream_keyed_load, stream_validation_stage

__all__ = ["stream_keyed_load", "stream_validation_stage"]
