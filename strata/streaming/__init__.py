"""Incremental execution of the layer operators with Structured Streaming.

The layered flows are batch jobs; the same pure ``DataFrame → DataFrame``
operators also run on a file stream, so new landing files can be taken into
bronze (and split into clean / quarantine) as they arrive, with progress kept
in a checkpoint folder instead of by the caller.
"""

from strata.streaming.incremental import stream_layer, stream_split  # noqa: F401
