"""The settings that a stream's state depends on, stored beside its checkpoint.

Rows that wait in join state carry their salt, and windows and watermarks are part of
the state's keys, so a restart with other settings would lose state without an error.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from stationflow.session import read_text, write_text


def check_settings(spark: SparkSession, checkpoint_path: str, settings: dict) -> None:
    """Store the settings at the first start; refuse others at a restart."""
    path = f"{checkpoint_path.rstrip('/')}_settings.json"
    text = read_text(spark, path)
    if text is None:
        write_text(spark, path, json.dumps(settings, sort_keys=True))
        return
    stored = json.loads(text)
    changed = {k: (stored.get(k), settings.get(k)) for k in {*stored, *settings} if stored.get(k) != settings.get(k)}
    if changed:
        raise ValueError(f"the stream at {checkpoint_path} was started with other settings (stored, given): {changed}")
