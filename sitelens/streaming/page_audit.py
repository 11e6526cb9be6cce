"""Incremental page audit: arriving page snapshots -> audit rows, crash-safe.

The audit itself is stateless per page, so the streaming form is the batch operator
on a file stream, appended to a file sink with a checkpoint; a restart
resumes after the last committed batch instead of redoing the crawl.  A
capture that is delivered again is recognised by its URL and time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.audit import page_audit

CAPTURED = "fetched_at"


def audit_stream(snapshots: DataFrame, prepare: Callable[[DataFrame], DataFrame] | None = None,
                 once_within: str | None = None, keep: tuple[str, ...] = (), **audit_kw) -> DataFrame:
    """Audit rows of arriving ``snapshots`` (see ``start_page_audit_stream``)."""
    snaps = prepare(snapshots) if prepare else snapshots
    if once_within is not None:
        keep = tuple(dict.fromkeys((*keep, CAPTURED)))
    audit = page_audit(snaps, keep=keep, **audit_kw)
    if once_within is not None:
        audit = audit.withWatermark(CAPTURED, once_within).dropDuplicatesWithinWatermark(["URL", CAPTURED])
    return audit


def start_page_audit_stream(snapshots: DataFrame, sink: str, checkpoint: str,
                            prepare: Callable[[DataFrame], DataFrame] | None = None,
                            available_now: bool = True, once_within: str | None = None,
                            keep: tuple[str, ...] = (), **audit_kw):
    """``snapshots``: a streaming DataFrame; ``prepare`` maps it to snapshot columns.

    ``once_within`` (such as ``"7 days"``): a capture, that is a URL and its
    ``fetched_at``, gives one row however often it is delivered.  The keys of
    captures within that time of the newest one are kept as state, and captures
    older than that are dropped as late.  Only the audit's short rows are
    shuffled for it, never page bytes.
    """
    audit = audit_stream(snapshots, prepare, once_within, keep, **audit_kw)
    writer = (audit.writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
