"""Incremental runs of the batch verbs over arriving report exports.

The reference has no streaming operators (no watermark, state or late data);
its verbs are batch jobs.  This package only re-runs the batch report for
the files that arrive, through Structured Streaming's file source and
``foreachBatch``, replacing exactly the output partitions of those files.
"""

from tradelens.streaming.reports import start_report_stream

__all__ = ["start_report_stream"]
