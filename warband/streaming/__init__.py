from warband.streaming.xes_stream import ingest_stream  # noqa: F401
