from pricelens.streaming.incremental import merge_into_bronze, stream_pages_to_bronze

__all__ = ["merge_into_bronze", "stream_pages_to_bronze"]
