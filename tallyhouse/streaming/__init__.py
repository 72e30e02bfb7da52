from .ingest import bronze_stream, land_stream
from .layers import stream_layers

__all__ = ["bronze_stream", "land_stream", "stream_layers"]
