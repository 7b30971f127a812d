from carelake.streaming.incremental import incremental_load, read_loaded, start_continuous_load

__all__ = ["incremental_load", "read_loaded", "start_continuous_load"]
