from strata.streaming.incremental import stream_documents_partitioned

__all__ = ["stream_documents_partitioned"]
