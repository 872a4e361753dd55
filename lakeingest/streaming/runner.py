"""One pass of the engine over a list of datasets."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..session import prepare
from ..sources import read_source
from ..spec import DatasetSpec, EngineSpec, select_active
from .audit import IngestResult, append_audit, log_summary
from .catalog import bootstrap, register_table
from .sink import BronzeWriter, has_committed_data, start_bronze_stream, table_path

log = logging.getLogger(__name__)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _root_cause(exc: BaseException) -> str:
    """Message of the innermost JVM cause (e.g. the parser error behind a failed file read)."""
    jexc = getattr(exc, "_origin", None) or getattr(exc, "java_exception", None)
    last = None
    try:
        while jexc is not None:
            last = jexc
            jexc = jexc.getCause()
        return "" if last is None else str(last.toString())
    except Exception:
        return ""


def _error_text(exc: BaseException) -> str:
    """``Type: message`` (first line) plus the root cause, cut at 1000 characters."""
    first = str(exc).strip().splitlines()[0] if str(exc).strip() else ""
    text = f"{type(exc).__name__}: {first}"
    cause = _root_cause(exc)
    if cause and cause.splitlines()[0] not in text:
        text += f" | cause: {cause.splitlines()[0]}"
    return text[:1000]


def _finished_at(query: StreamingQuery) -> datetime:
    """End of the query's last micro-batch, so later datasets do not show inflated durations."""
    progress = query.lastProgress
    if not progress:
        return _now()
    start = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
    return start + timedelta(milliseconds=(progress.durationMs or {}).get("triggerExecution", 0))


def _result(run_id: str, ds: DatasetSpec, engine: EngineSpec, started: datetime, finished: datetime,
            rows: int, status: str, error: str = "") -> IngestResult:
    return IngestResult(run_id, ds.datasource, ds.dataset, ds.source_format, table_path(ds, engine),
                        started, finished, rows, status, error)


def _register_first(spark: SparkSession, engine: EngineSpec):
    """Registers the table of a continuous dataset when its first batch of this run is in it."""
    def committed(writer: BronzeWriter) -> None:
        if writer.batches == 1 and engine.register_tables:
            try:
                bootstrap(spark, engine)
                register_table(spark, engine, writer.ds)
            except Exception as exc:
                log.warning("[%s] data written but table not registered: %s", writer.ds.name, exc)
    return committed


class _Ended(StreamingQueryListener):
    """Adds the audit row of a continuous query when it ends: all rows of all its batches, and how it ended."""

    def __init__(self):
        self.watched: dict[str, Callable[[str | None], None]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        done = self.watched.pop(str(event.runId), None)
        if done is not None:
            done(event.exception)


_ENDED: dict[str, _Ended] = {}


def watch(spark: SparkSession, engine: EngineSpec, run_id: str, ds: DatasetSpec, query: StreamingQuery, writer: BronzeWriter,
          started: datetime) -> None:
    """Audit a continuous query at its end (``STOPPED`` or ``ERROR``) beside the ``RUNNING`` row of its run."""
    app = spark.sparkContext.applicationId
    if app not in _ENDED:
        _ENDED[app] = _Ended()
        spark.streams.addListener(_ENDED[app])

    def done(exception: str | None) -> None:
        status, text = ("ERROR", _error_text(writer.error) if writer.error else str(exception)[:1000]) if exception else ("STOPPED", "")
        append_audit(spark, engine, [_result(run_id, ds, engine, started, _now(), writer.rows, status, text)])

    _ENDED[app].watched[str(query.runId)] = done


def run_ingestion(spark: SparkSession, engine: EngineSpec, datasets: list[DatasetSpec],
                  run_id: str | None = None, only: list[str] | None = None,
                  parallelism: int = 8) -> list[IngestResult]:
    """Ingest every enabled dataset; one failing dataset never stops the others.

    All queries are started first (up to ``parallelism`` at a time) so independent
    datasets overlap inside Spark, then awaited in configuration order.
    Continuous queries are reported as RUNNING and left running; each gets another
    audit row with all its rows when it ends. Every other dataset gets one audit row.
    """
    prepare(spark)
    run_id = run_id or uuid.uuid4().hex[:12]
    active = select_active(datasets, only)
    log.info("run_id=%s | %d dataset(s)", run_id, len(active))

    results: list[IngestResult] = []
    in_flight: list[tuple[DatasetSpec, StreamingQuery, datetime, BronzeWriter]] = []

    def start(ds: DatasetSpec):
        started = _now()
        try:
            stream, rows_of = read_source(spark, ds, engine)
            first = _register_first(spark, engine) if ds.continuous else None
            query, writer = start_bronze_stream(spark, ds, engine, stream, rows_of, first)
            return ds, query, started, writer, None
        except Exception as exc:
            log.error("[%s] could not start: %s", ds.name, exc)
            failed = _result(run_id, ds, engine, started, _now(), 0, "ERROR", _error_text(exc))
            return ds, None, started, None, failed

    # Phase 1: resolve schemas and start every query. The driver-side preparation
    # (file listing, inference over new files) of independent datasets overlaps.
    workers = max(1, min(parallelism, len(active)))
    with ThreadPoolExecutor(max_workers=workers, thread_name_prefix="lakeingest-start") as pool:
        for ds, query, started, writer, failed in pool.map(start, active):
            if failed is not None:
                results.append(failed)
            else:
                in_flight.append((ds, query, started, writer))

    registered_ok: list[DatasetSpec] = []
    for ds, query, started, writer in in_flight:
        if ds.continuous:
            log.info("[%s] continuous query active (id=%s)", ds.name, query.id)
            watch(spark, engine, run_id, ds, query, writer, started)
            results.append(_result(run_id, ds, engine, started, _now(), writer.rows, "RUNNING"))
            registered_ok.append(ds)
            continue
        try:
            query.awaitTermination()
            writer.publish()
            log.info("[%s] done, %d row(s) in %d batch(es)", ds.name, writer.rows, writer.batches)
            results.append(_result(run_id, ds, engine, started, _finished_at(query), writer.rows, "OK"))
            registered_ok.append(ds)
        except Exception as exc:
            # Batches committed before the failure stay in the table: report them.
            log.error("[%s] failed: %s", ds.name, exc)
            results.append(_result(run_id, ds, engine, started, _finished_at(query), writer.rows, "ERROR",
                                   _error_text(writer.error or exc)))

    if engine.register_tables and registered_ok:
        try:
            bootstrap(spark, engine)
        except Exception as exc:
            log.warning("catalog bootstrap failed: %s", exc)
        for ds in registered_ok:
            if not has_committed_data(spark, ds, engine):
                # A continuous query may not have committed a batch yet: the next run registers it.
                log.info("[%s] nothing committed yet; table registration deferred", ds.name)
                continue
            try:
                register_table(spark, engine, ds)
            except Exception as exc:  # data is written; registration is a convenience
                log.warning("[%s] data written but table not registered: %s", ds.name, exc)

    append_audit(spark, engine, results)
    log_summary(results)
    return results
