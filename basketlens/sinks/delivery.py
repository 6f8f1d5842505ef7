"""Delivery of alerts to an outside channel through a callable supplied by the caller."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.functions.render import DELIVERY_PREFIX, alert_text
from basketlens.sinks.streams import batch_files

ALERT_LOG_SCHEMA = "customer_id BIGINT, reason STRING, value STRING, message STRING, delivered BOOLEAN, error STRING"

# Fixed value: the status with which the channel confirms a message.
ACCEPTED = 204


def http_sender(url: str, timeout: float = 5.0) -> Callable[[dict], int]:
    """A channel that posts each message as JSON."""

    def send(message: dict) -> int:
        request = urllib.request.Request(
            url, json.dumps(message).encode(), {"Content-Type": "application/json"}, method="POST"
        )
        with urllib.request.urlopen(request, timeout=timeout) as response:
            return response.status

    return send


def deliver(alerts: DataFrame, send: Callable[[dict], int], attempts: int = 3) -> DataFrame:
    """Send ``{"content": text}`` for every alert, from the tasks that hold the alerts.

    ``send`` returns a status code; anything but 204, or an exception, is tried again. A failure
    is recorded and never stops the stream: every alert comes back with its outcome.
    """

    def send_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            outcomes = [_send_one(send, text, attempts) for text in rows["message"]]
            yield rows.assign(
                delivered=pd.array([e is None for e in outcomes], dtype="boolean"),
                error=pd.array(outcomes, dtype="string"),
            )

    prepared = alerts.select(
        F.col("customer_id").cast("bigint").alias("customer_id"), "reason", "value",
        F.concat(
            F.lit(DELIVERY_PREFIX), alert_text(F.col("customer_id"), F.col("reason"), F.col("value"))
        ).alias("message"),
    )
    return prepared.mapInPandas(send_all, ALERT_LOG_SCHEMA)


def _send_one(send: Callable[[dict], int], text: str, attempts: int) -> str | None:
    error = None
    for _ in range(attempts):
        try:
            status = send({"content": text})
        except Exception as failure:  # the channel may fail in any way
            error = f"{type(failure).__name__}: {failure}"
            continue
        if status == ACCEPTED:
            return None
        error = f"status {status}"
    return error


def delivery_handler(
    log_path: str, send: Callable[[dict], int], attempts: int = 3
) -> Callable[[DataFrame, int], None]:
    """Batch handler that delivers a batch and writes the delivery log of that batch.

    A batch whose log is complete is not sent again after a restart. A task lost halfway is
    repeated, so delivery is at least once.
    """
    write = batch_files(log_path, lambda alerts: deliver(alerts, send, attempts))

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not _logged(batch, log_path, batch_id):
            write(batch, batch_id)

    return handle


def _logged(batch: DataFrame, log_path: str, batch_id: int) -> bool:
    """Whether the log has outcomes of the batch; reads that batch's folder alone."""
    reader = batch.sparkSession.read.schema(f"{ALERT_LOG_SCHEMA}, batch_id BIGINT")
    try:
        return not reader.parquet(log_path).filter(F.col("batch_id") == batch_id).isEmpty()
    except AnalysisException as missing:  # nothing has been logged yet
        if "PATH_NOT_FOUND" in str(missing):
            return False
        raise
