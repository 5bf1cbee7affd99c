"""clickflow: clickstream and commerce analytics operators on Spark.

Batch operators live in ``clickflow.operators`` (one module per family) and
take / return DataFrames; their streaming forms, keyed state and runnable
end-to-end apps are in ``clickflow.streaming``; writers in ``clickflow.sinks``;
decoders for the raw input formats in ``clickflow.sources.scans``. The named
queries used by ``__spark_entry__`` (and their SQL oracles) are in
``clickflow.plans``. Build a session with ``clickflow.session.build_session``
and size a cluster job with ``clickflow.session.scale_conf``.
"""

__version__ = "0.1.0"
