"""Structured Streaming driver for the stage load (no new operator).

The reference has no stream, watermark or stateful operator.  What it does
have is an incremental hand-over: every batch drops one landing directory
per table and the stage load picks it up.  ``landing.stage_stream`` runs
that same stage function over a file stream with ``availableNow``, so each
landing directory is processed exactly once, tracked by a checkpointed
offset log instead of by the batch date.
"""
