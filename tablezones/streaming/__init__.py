from tablezones.streaming.incremental import run_incremental_transform, start_incremental_transform

__all__ = ["run_incremental_transform", "start_incremental_transform"]
